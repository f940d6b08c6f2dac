"""Quantities recorded in different units, scales and formats, brought to one unit.

Method: the distinct spellings of unit words are mapped to a lexicon through an inverted index of
character bigrams, verified by a weighted edit distance; the resulting alias dictionary is joined to
the tokens of every text; a small grammar then reads amounts off the mapped tokens. Texts repeat, so
all of this runs once per distinct text and is joined back to the rows. Numbers without text take the
scale that their source is seen to store numbers in, measured over all rows that have both.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaglio.functions.distance import weighted_edit
from vaglio.session import small_side

#: Unit words and what they stand for. C currency, S scale, R role of the amount that follows, X a total that is not an applicant's.
LEXICON = {
    "C:EUR": ["€", "euro", "eur", "euri", "euros"],
    "C:CHF": ["chf", "sfr", "fr", "franchi", "franken", "francs", "franco"],
    "C:USD": ["usd", "$", "us$", "dollari", "dollars", "dollar", "dollaro"],
    "C:GBP": ["gbp", "£", "pounds", "pound", "sterline", "sterling", "sterlina", "pfund"],
    "S:1000": ["k", "mila", "migliaia", "migl", "thousand", "tausend", "tsd"],
    "S:1000000": ["m", "mln", "mio", "milione", "milioni", "million", "millions", "millionen", "mill"],
    "S:1000000000": ["mrd", "miliardo", "miliardi", "billion", "billions", "milliarde", "milliarden"],
    "R:max": ["max", "massimo", "massima", "fino", "bis", "up", "höchstens", "maximal", "maximum", "ciascuno", "tetto", "massimale"],
    "R:min": ["min", "minimo", "minima", "almeno", "partire", "mindestens", "minimum", "ab", "least"],
    "X:total": ["dotazione", "complessiva", "complessivo", "totale", "stanziamento", "budget", "gesamt", "plafond", "stanziati"],
    "J:": ["a", "e", "ed", "to", "and", "und", "al", "di", "zu", "an", "-", "–", "—", "/"],
}

#: Longest edit distance, as a share of the longer spelling, at which a spelling is an alias.
EDIT_SHARE = 0.25
#: Shorter spellings are matched exactly only.
FUZZY_FROM = 5

#: Italian number words.
_ONES = ["zero", "uno", "due", "tre", "quattro", "cinque", "sei", "sette", "otto", "nove", "dieci", "undici", "dodici", "tredici", "quattordici", "quindici", "sedici", "diciassette", "diciotto", "diciannove"]
_TENS = {"venti": 20, "trenta": 30, "quaranta": 40, "cinquanta": 50, "sessanta": 60, "settanta": 70, "ottanta": 80, "novanta": 90}

TOKEN = r"(?i)\d+(?:[.,'’]\d+)*|us\$|[€$£%;,:/–—-]|[\p{L}]+"


def _below_hundred() -> dict[str, int]:
    words = {w: i for i, w in enumerate(_ONES)} | {"un": 1, "una": 1}
    for w, v in _TENS.items():
        words[w] = v
        for i, one in enumerate(_ONES[1:10], 1):
            words[(w[:-1] if one[0] in "uo" else w) + one] = v + i
    return words


_WORDS = _below_hundred()


def number_word(w: str) -> int | None:
    """The value of an Italian number word up to 999,999, or None."""
    if w.startswith("mille"):
        rest = number_word(w[5:]) if w != "mille" else 0
        return None if rest is None or rest >= 1000 else 1000 + rest
    head, sep, tail = w.partition("mila")
    if sep:
        a, b = number_word(head) if head else None, number_word(tail) if tail else 0
        return None if a is None or b is None else a * 1000 + b
    head, sep, tail = w.partition("cento")
    if sep:
        a, b = _WORDS.get(head) if head else 1, (_WORDS.get(tail) if tail else 0)
        return None if a is None or b is None or not 1 <= a <= 9 else a * 100 + b
    return _WORDS.get(w)


def parse_number(s: str) -> float:
    """A number in Italian, English or Swiss format. One separator before exactly three digits groups."""
    s = s.replace("'", "").replace("’", "")
    dots, commas = s.count("."), s.count(",")
    if dots and commas:
        decimal = max(s.rfind("."), s.rfind(","))
        return float(re.sub(r"[.,]", "", s[:decimal]) + "." + re.sub(r"[.,]", "", s[decimal + 1 :]))
    if dots + commas > 1 or re.search(r"[.,]\d{3}$", s):
        return float(re.sub(r"[.,]", "", s))
    return float(s.replace(",", "."))


def read_amounts(mapped: str) -> tuple[float | None, float | None, str | None]:
    """Minimum, maximum and currency off mapped tokens, which are kind:value words parted by blanks.

    A number counts if a currency or scale word stands beside it, or if only joining words part it from
    a number that counts. Of two unnamed amounts the smaller is the minimum; a lone one is the maximum,
    unless named otherwise. Amounts after a word for the whole budget do not count, up to the next
    comma, semicolon or word that names a bound.
    """
    tokens = [t.partition(":")[::2] for t in mapped.split(" ") if t]
    found: list[dict] = []
    joined, role, total, ahead_scale, ahead_currency = False, None, False, None, None
    standing: float | None = None
    i = 0
    while i < len(tokens):
        kind, value = tokens[i]
        if kind in ("D", "N"):
            if i + 1 < len(tokens) and tokens[i + 1] == ("P", "%"):
                joined, ahead_scale, ahead_currency, i = False, None, None, i + 2
                continue
            item = {"n": parse_number(value) if kind == "D" else float(value), "scale": ahead_scale, "cur": ahead_currency, "role": role, "total": total, "joined": joined, "grouped": bool(re.search(r"[.,'’]\d{3}(\D|$)", value)), "word": kind == "N"}
            i += 1
            # what follows the number: a scale, "di", a currency, in this order
            if i < len(tokens) and tokens[i] == ("N", "1000") and kind == "D":  # "80 mille"
                tokens[i] = ("S", "1000")
            if i < len(tokens) and tokens[i][0] == "S" and item["scale"] is None:
                item["scale"], i = float(tokens[i][1]), i + 1
                if i < len(tokens) and tokens[i][0] == "S":  # "5000 mila" after "k" does not occur; "mille milioni" does
                    item["scale"], i = item["scale"] * float(tokens[i][1]), i + 1
            j = i + (i < len(tokens) and tokens[i] == ("J", "di"))
            if j < len(tokens) and tokens[j][0] == "C" and item["cur"] is None:
                item["cur"], i = tokens[j][1], j + 1
            if item["scale"] is None and standing is not None:
                item["scale"], item["held"] = standing, True
            previous = found[-1] if found else None
            if previous and joined == "e" and previous["scale"] and item["scale"] and previous["scale"] > item["scale"] and previous["cur"] is None and not item.get("held"):
                # "un milione e 500 mila": one amount in two scales
                previous["n"], previous["scale"], previous["cur"] = previous["n"] * previous["scale"] + item["n"] * item["scale"], 1.0, item["cur"]
            else:
                found.append(item)
            joined, role, ahead_scale, ahead_currency = "start", None, None, None
            continue
        if kind == "S":
            ahead_scale = float(value)
        elif kind == "C":
            ahead_currency = value
        elif kind == "P" and value == ":":
            if ahead_scale is not None:
                standing = ahead_scale
        elif kind == "R":
            role, total = value, False
            if value == "max" and joined:
                joined = "bis"
        elif kind == "X":
            total = True
        elif kind == "P" and value in ",;":
            total, joined = False, False
        elif kind == "J":
            if joined:
                joined = value
        else:
            joined = False
        if kind not in ("S", "C", "J") and not (kind == "P" and value == ":"):
            ahead_scale = ahead_currency = None
        i += 1
    own = [bool(x["cur"] or x["scale"]) for x in found]
    for k in range(len(found) - 1, 0, -1):  # a number joined to one that counts, counts
        if own[k] and found[k]["joined"] and not own[k - 1]:
            own[k - 1] = True
            if found[k]["scale"] and found[k - 1]["cur"] is None and not found[k - 1]["grouped"]:
                found[k - 1]["scale"] = found[k]["scale"]
    for k in range(1, len(found)):
        if own[k - 1] and found[k]["joined"] and not own[k]:
            own[k] = True
    # "da 1,5 a 2,5 mln": the scale of the second holds for the first
    for k in range(1, len(found)):
        a, b = found[k - 1], found[k]
        if b["joined"] and b["scale"] and a["scale"] is None and a["cur"] is None and not a["grouped"] and not a["word"]:
            a["scale"] = b["scale"]
    kept = [x for x, o in zip(found, own) if o and not x["total"]]
    if not kept:
        return None, None, None
    currency = next((x["cur"] for x in kept if x["cur"]), None) or next((v for k, v in tokens if k == "C"), "EUR")
    for x in kept:
        x["amount"] = x["n"] * (x["scale"] or 1.0)
    low = [x["amount"] for x in kept if x["role"] == "min"]
    high = [x["amount"] for x in kept if x["role"] == "max"]
    free = [x["amount"] for x in kept if x["role"] is None]
    if len(free) >= 2 and not low and not high:
        low, high = [min(free[:2])], [max(free[:2])]
    elif free and high and not low:
        low = free[:1]
    elif free and not high:
        high = free[:1]
    a, b = (min(low) if low else None), (max(high) if high else None)
    return a or None, b or None, currency


def lexicon(spark) -> DataFrame:
    """term, mapped: the fixed list above, some hundred rows whatever the data."""
    rows = [(term, f"{code.rstrip(':')}:{term}" if code == "J:" else code) for code, terms in LEXICON.items() for term in terms]
    return spark.createDataFrame(rows, "term STRING, mapped STRING")


def _grams(column):
    padded = F.concat(F.lit("^"), column, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))))


@F.pandas_udf(T.DoubleType())
def _edit(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_edit(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.StringType())
def _number_words(w: pd.Series) -> pd.Series:
    values = [number_word(x) for x in w]
    return pd.Series([None if v is None else f"N:{v}" for v in values], dtype="object")


def alias_dictionary(spellings: DataFrame) -> DataFrame:
    """spelling, mapped: each distinct spelling that names a unit, bound or number.

    spellings: spelling STRING, distinct, in lower case. Exact terms and number words first; the rest
    of at least FUZZY_FROM letters share two bigrams or more with a term and lie within EDIT_SHARE of
    it; the nearest term wins, on a tie the one sharing more bigrams, then the first by name.
    """
    terms = F.broadcast(lexicon(spellings.sparkSession))
    exact = spellings.join(terms, F.col("spelling") == F.col("term"), "left").select("spelling", F.coalesce("mapped", _number_words("spelling")).alias("mapped"))
    index = lexicon(spellings.sparkSession).where(F.length("term") >= FUZZY_FROM - 1).select("term", "mapped", F.explode(_grams(F.col("term"))).alias("gram"))
    near = (
        exact.where(F.col("mapped").isNull() & (F.length("spelling") >= FUZZY_FROM))
        .select("spelling", F.explode(_grams(F.col("spelling"))).alias("gram"))
        .join(F.broadcast(index), "gram")
        .groupBy("spelling", "term", "mapped")
        .agg(F.count("*").alias("shared"))
        .where((F.col("shared") >= 2) & (F.abs(F.length("spelling") - F.length("term")) <= EDIT_SHARE * F.greatest(F.length("spelling"), F.length("term"))))
        .withColumn("edit", _edit("spelling", "term"))
        .where(F.col("edit") <= EDIT_SHARE * F.greatest(F.length("spelling"), F.length("term")))
        .groupBy("spelling")
        .agg(F.min(F.struct("edit", -F.col("shared"), "term", "mapped")).alias("best"))
        .select("spelling", F.col("best.mapped").alias("mapped"))
    )
    return exact.where(F.col("mapped").isNotNull()).unionByName(near)


@F.pandas_udf(T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()), T.StructField("currency", T.StringType())]))
def _read(mapped: pd.Series) -> pd.DataFrame:
    rows = [(None, None, None) if m is None else read_amounts(m) for m in mapped]
    out = pd.DataFrame(rows, columns=["low", "high", "currency"])
    return out.astype({"low": "float64", "high": "float64"})


def tokens_of(texts: DataFrame) -> DataFrame:
    """funding_text, pos, token of each distinct text."""
    return texts.select("funding_text", F.posexplode(F.regexp_extract_all(F.lower("funding_text"), F.lit(TOKEN), F.lit(0))).alias("pos", "token"))


def text_amounts(texts: DataFrame) -> DataFrame:
    """funding_text, low, high, currency of each distinct text that states an amount.

    texts: funding_text STRING, distinct, no nulls. Null bounds are not stated.
    """
    tokens = tokens_of(texts)
    words = tokens.where(~F.col("token").rlike(r"^[\d%;,:]")).select(F.col("token").alias("spelling")).distinct()
    aliases, _ = small_side(alias_dictionary(words))
    code = (
        F.when(F.col("token").rlike(r"^\d"), F.concat(F.lit("D:"), "token"))
        .when(F.col("token").rlike("^[%;,:]$"), F.concat(F.lit("P:"), "token"))
        .otherwise(F.coalesce("mapped", F.lit("W:")))
    )
    return (
        tokens.join(aliases, F.col("token") == F.col("spelling"), "left")
        .groupBy("funding_text")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", code.alias("code")))), lambda x: x["code"]), " ").alias("mapped"))
        .select("funding_text", _read("mapped").alias("r"))
        .select("funding_text", "r.low", "r.high", "r.currency")
        .where(F.col("low").isNotNull() | F.col("high").isNotNull())
    )


def _positive(name: str):
    c = F.col(name)
    return F.when(c.isNotNull() & ~F.isnan(c) & (c > 0), c)


def number_habits(both: DataFrame) -> DataFrame:
    """source_id, factor: what a source's stored numbers are to be multiplied by.

    both: source_id, stored, stated. The most frequent power of ten between stated and stored, over all
    rows with both and within 1 % of a power; on a tie the one nearest to one. One row a source.
    """
    power = F.round(F.log10(F.col("stated") / F.col("stored")))
    return (
        both.where((F.col("stored") > 0) & (F.col("stated") > 0))
        .select("source_id", power.alias("power"), F.abs(F.log10(F.col("stated") / F.col("stored")) - power).alias("off"))
        .where(F.col("off") < 0.005)
        .groupBy("source_id", "power")
        .count()
        .groupBy("source_id")
        .agg(F.max(F.struct("count", -F.abs("power"), "power")).alias("best"))
        .select("source_id", F.pow(F.lit(10.0), F.col("best.power")).alias("factor"))
    )


def bounds_in_euro(grants: DataFrame, rates: DataFrame) -> DataFrame:
    """grant_id, bound ('min' or 'max'), amount_eur: what a single applicant may receive, in whole euro.

    The text's amounts where it states any, in the currency it names (euro if none); else the stored
    numbers, which are euro in their source's scale. Zero, negative, null and NaN numbers state
    nothing; a currency without rate gives no row. A repeated row gives its bounds once.
    """
    rows = grants.select("grant_id", "source_id", "funding_text", _positive("funding_min").alias("funding_min"), _positive("funding_max").alias("funding_max"))
    texts = rows.where("funding_text IS NOT NULL").select("funding_text").distinct()
    stated = text_amounts(texts)
    read = rows.join(stated, "funding_text", "left")
    pairs = read.where(F.col("low").isNotNull() | F.col("high").isNotNull()).select("source_id", F.explode(F.array(F.struct(F.col("funding_min").alias("stored"), F.col("low").alias("stated")), F.struct(F.col("funding_max").alias("stored"), F.col("high").alias("stated")))).alias("p")).select("source_id", "p.*")
    habits, _ = small_side(number_habits(pairs))
    in_text = F.col("low").isNotNull() | F.col("high").isNotNull()
    factor = F.coalesce(F.col("factor"), F.lit(1.0))
    rate = F.broadcast(rates.groupBy("currency").agg(F.max("eur_rate").alias("eur_rate")))
    full = read.join(habits, "source_id", "left").select(
        "grant_id",
        F.coalesce("currency", F.lit("EUR")).alias("currency"),
        F.when(in_text, F.col("low")).otherwise(F.col("funding_min") * factor).alias("low"),
        F.when(in_text, F.col("high")).otherwise(F.col("funding_max") * factor).alias("high"),
    )
    return (
        full.join(rate, "currency", "left")
        .withColumn("eur_rate", F.when(F.col("currency") == "EUR", F.coalesce("eur_rate", F.lit(1.0))).otherwise(F.col("eur_rate")))
        .select("grant_id", F.explode(F.array(F.struct(F.lit("min").alias("bound"), (F.col("low") * F.col("eur_rate")).alias("v")), F.struct(F.lit("max").alias("bound"), (F.col("high") * F.col("eur_rate")).alias("v")))).alias("b"))
        .where(F.col("b.v").isNotNull() & (F.col("b.v") > 0))
        .select("grant_id", "b.bound", F.round("b.v").cast("bigint").alias("amount_eur"))
        .distinct()
    )
