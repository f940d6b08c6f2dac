"""Matching entities across sources that share no identifier.

Method: label-model linkage. Candidates share one of several blocking keys of partial attributes. On each
candidate, heuristic matching functions vote match, no match or nothing. A generative model is fitted to the
votes by expectation maximisation: for matches and non-matches it learns how each function votes, and which
function each leans on (a tree of the strongest dependences, found from the votes), so that functions that
say the same thing twice are not counted twice. The posterior is the confidence of a pair. The votes of all
candidates are counted by pattern; only those counts, at most 3 to the number of functions, are collected.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaglio.functions.distance import weighted_edit
from vaglio.llm.leakage import fold
from vaglio.llm.names import monge_elkan, parse_name
from vaglio.operators.units import bounds_in_euro
from vaglio.session import durable

FUNCTIONS = ("theme", "audience", "issuer", "deadline", "amount", "year", "line", "label", "time", "place", "terms")
#: Days of one time bucket; a register record is a candidate for its own bucket and the two beside it.
BUCKET_DAYS = 60
#: Posterior from which a pair counts as found.
FOUND = 0.5

#: Where the label model starts: what an agreement adds and a contradiction takes, by function, and the even score.
START = (np.array([0.5, 0.5, 1.5, 1.5, 1.0, 0.5, 0.5, 1.5, 0.5, 0.5, 0.5]), np.array([2.0, 2.0, 2.5, 2.0, 1.5, 2.5, 2.5, 2.5, 2.0, 1.0, 0.0]))
START_AT = 3.6

#: What portals wrap a title in.
WRAPPERS = set("avviso bando bandi pubblico misura voucher contributi contributo incentivi incentivo agevolazioni agevolazione sostegno call proroga programma fondo perduto nuovo edizione anno per il lo la gli le l i al allo alla all ai agli alle del dello della dell dei degli delle di e ed a in con su the for".split())
#: Short and other words for the same thing in titles.
SAME = {"export": "internazionalizzazione", "az": "aziende", "innov": "innovative", "microimpr": "microimprese", "coop": "cooperative", "assoc": "associazioni", "prof": "professionisti"}
#: Deadlines that stand for none.
NO_DATE_YEARS = (2000, 2090)

_YEAR = re.compile(r"\b(20[0-4]\d)\b")
_LINE = re.compile(r"\blinea\s+([a-z0-9]{1,2})\b")
#: Words that name whom a call is for, by a code for each group.
AUDIENCES = {
    "pmi": "pmi", "piccole": "pmi", "medie": "pmi", "microimprese": "micro", "artigiane": "artigiane", "agricole": "agricole", "organismi": "ricerca",
    "centri": "ricerca", "locali": "enti", "enti": "enti", "reti": "reti", "cooperative": "coop", "giovani": "giovani", "professionisti": "professionisti",
    "associazioni": "associazioni", "start": "startup", "startup": "startup", "innovative": "startup",
}
#: Words beside those that tell nothing.
BESIDE = set("imprese impresa aziende up micro".split())


def parse_title(title: str | None) -> tuple[list[str], list[str], str, str, str]:
    """Theme words, audience codes, year, line and label (a name in quotes, brackets or before a dash) of a title."""
    raw = title or ""
    text = fold(raw)
    year = (_YEAR.search(text) or [None, ""])[1]
    line = (_LINE.search(text) or [None, ""])[1]
    text = _LINE.sub(" ", _YEAR.sub(" ", text))
    label = ""
    m = re.match(r"""\s*["«“]([^"»”]{3,40})["»”]""", text) or re.match(r"\s*(?:programma\s+)?([a-z]{5,20})\s*(?:[–:-])\s", text) or re.search(r"\[([^\]]{3,40})\]", text)
    if m and m[1].strip() not in WRAPPERS:
        label = re.sub(r"[^a-z0-9]", "", m[1])
        text = text[: m.start()] + " " + text[m.end() :]
    theme, audience = [], []
    words = [SAME.get(w, w) for w in re.findall(r"[a-z0-9]+", text) if w not in WRAPPERS and len(w) > 1]
    for w in words:
        code = _audience(w)
        if code == "ricerca":
            audience.append(code)
        elif w == "ricerca" and "ricerca" in audience:
            continue
        elif code:
            audience.append(code)
        elif w not in BESIDE:
            theme.append(w)
    return theme, sorted(set(audience)), year, line, label


@functools.lru_cache(maxsize=100_000)
def _audience(word: str) -> str:
    """The audience that a word, or a slip or short form of it, names; or nothing."""
    if word in AUDIENCES:
        return AUDIENCES[word]
    if len(word) < 5:
        return ""
    for known, code in AUDIENCES.items():
        if len(known) >= 5 and ((len(word) >= 6 and known.startswith(word)) or (abs(len(known) - len(word)) <= 1 and weighted_edit(word, known) <= 1)):
            return code
    return ""


#: Entries of each of the caches of votes in a Python worker; words and names come back far more often than pairs.
CACHED = 200_000


@functools.lru_cache(maxsize=CACHED)
def _like(p: str, q: str) -> bool:
    if p == q or (len(p) >= 4 and q.startswith(p)) or (len(q) >= 4 and p.startswith(q)):
        return True
    n = max(len(p), len(q))
    most = 2 if n >= 9 else 1
    return n >= 4 and abs(len(p) - len(q)) <= 2 and weighted_edit(p, q, most) <= most


def word_overlap(a: list[str], b: list[str]) -> float:
    """Share of the shorter side's words that have a like word on the other; abbreviations and slips count."""
    if not a or not b:
        return -1.0

    short, long = (a, b) if len(a) <= len(b) else (b, a)
    return sum(any(_like(p, q) for q in long) for p in short) / len(short)


@functools.lru_cache(maxsize=CACHED)
def _label_vote(x: str, y: str) -> int:
    if not x or not y:
        return 0
    most = 1.5 if max(len(x), len(y)) >= 7 else 1
    return 1 if weighted_edit(x, y, most) <= most else -1


def _theme_vote(s: float) -> int:
    return 1 if s >= 0.75 else 0 if s < 0 or s >= 0.5 else -1


_PARSED = T.StructType([
    T.StructField("theme", T.ArrayType(T.StringType())), T.StructField("audience", T.ArrayType(T.StringType())), T.StructField("year", T.StringType()),
    T.StructField("line", T.StringType()), T.StructField("label", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("core", T.StringType()), T.StructField("given", T.StringType()),
])


@functools.lru_cache(maxsize=CACHED)
def _name(issuer: str | None) -> tuple[str, str, str, str]:
    return parse_name(issuer)


@F.pandas_udf(_PARSED)
def _parsed(title: pd.Series, issuer: pd.Series) -> pd.DataFrame:
    rows = []
    for t, i in zip(title, issuer):
        kind, core, given, _ = _name(i)
        rows.append((*parse_title(t), "" if kind == "empty" else kind, core, given))
    return pd.DataFrame(rows, columns=_PARSED.names)


_VOTES = T.StructType([T.StructField(f, T.IntegerType()) for f in ("theme", "audience", "issuer", "label")])


@functools.lru_cache(maxsize=CACHED)
def _theme_votes(x: str, y: str) -> int:
    return _theme_vote(word_overlap(x.split(), y.split()))


@functools.lru_cache(maxsize=CACHED)
def _audience_votes(x: str, y: str) -> int:
    return 0 if not x or not y else 1 if set(x.split()) & set(y.split()) else -1


@functools.lru_cache(maxsize=CACHED)
def _issuer_votes(x_kind: str, x: str, x_given: str, y_kind: str, y: str, y_given: str) -> int:
    if not x or not y:
        return 0
    if (x_kind == y_kind or "other" in (x_kind, y_kind)) and (not x_given or not y_given or x_given.startswith(y_given) or y_given.startswith(x_given)):
        if x == y or monge_elkan(x, y) >= 0.83 or x.replace(" ", "") == y.replace(" ", ""):
            return 1
    acronym = "other" in (x_kind, y_kind) and min(len(x.split()), len(y.split())) == 1 and min(len(x), len(y)) <= 7
    return 0 if acronym else -1


def _label_votes(x: str, x_words: str, y: str, y_words: str) -> int:
    vote = _label_vote(x, y)
    if vote == 0 and (x or y):
        # a label that the other title holds among its words, or a place both name
        one, words = (x, y_words) if x else (y, x_words)
        return 1 if any(_label_vote(one, w) == 1 for w in words.split()) else 0
    return vote


#: What the votes on text read of a side, each as one string: lists of words would cost more to hand over than to compare.
_SAID = ("theme", "audience", "kind", "core", "given", "label")


@F.pandas_udf(_VOTES)
def _text_votes(*sides: pd.Series) -> pd.DataFrame:
    rows = []
    for theme, audience, kind, core, given, label, theme2, audience2, kind2, core2, given2, label2 in zip(*sides):
        rows.append((
            _theme_votes(theme, theme2), _audience_votes(audience, audience2), _issuer_votes(kind, core, given, kind2, core2, given2),
            _label_votes(label, f"{theme} {audience}", label2, f"{theme2} {audience2}"),
        ))
    return pd.DataFrame(rows, columns=_VOTES.names)


def _date(c: str) -> Column:
    d = F.col(c).cast("date")
    return F.when(F.year(d).between(*NO_DATE_YEARS), d)


def prepared(rows: DataFrame, number: str, when: str, place: str | None) -> DataFrame:
    """number, its attributes parsed, deadline, amount, seen (days since 1970), place."""
    p = rows.select(
        F.col(number).alias("id"), _parsed("title", "issuer").alias("p"), _date("deadline").alias("deadline"), F.col("amount").cast("double").alias("amount"),
        F.datediff(F.col(when).cast("date"), F.lit("1970-01-01").cast("date")).alias("seen"),
        (F.lower(F.col(place)) if place else F.lit(None).cast("string")).alias("place"),
    )
    stems = F.array_distinct(F.transform(F.filter(F.col("p.theme"), lambda w: F.length(w) >= 4), lambda w: F.substring(w, 1, 4)))
    return p.withColumn("stems", F.when(F.size(stems) > 0, stems).otherwise(F.array(F.lit("-"))))


def _keys(side: DataFrame, wide: bool) -> DataFrame:
    """id, key: the blocking keys of each row of side, all in one column; the wide side repeats time-bound keys in the buckets beside.

    Audience and theme stem with either half of the issuer's core and the time, with the deadline, and
    with the label; audience and whole issuer with the deadline; and audience and theme stem with the amount
    (within 5 %, either side of a step) and the time. A row whose time is unknown takes the time of its
    deadline, or bucket 0; for the amount, bucket 0.

    The keys of an audience are those of rows that name it. Keys without audience, and those of the amount,
    are for pairs of which a row lacks audience or issuer: what the narrow row lacks is part of the key, and
    the wide side takes the key of a complete row only where it lacks that itself. So each pair meets once a key.
    """
    silent, seen = F.size("p.audience") == 0, F.floor(F.col("seen") / BUCKET_DAYS)
    due = F.floor((F.datediff("deadline", F.lit("1970-01-01").cast("date")) - 60) / BUCKET_DAYS)
    step = F.log(F.col("amount")) / F.log(F.lit(1.1))
    said = F.transform("p.audience", lambda a: F.struct(F.lit("says").alias("how"), a.alias("aud")))
    lacks, whole = (F.struct(F.lit(how).alias("how"), F.lit("*").alias("aud")) for how in ("lacks", "whole"))
    if wide:
        auds = F.concat(said, F.array(lacks), F.array_repeat(whole, silent.cast("int")))
    else:
        auds = F.concat(said, F.array(F.when(silent, lacks).otherwise(whole)))
    rows = side.select(
        "id", "deadline", F.replace(F.col("p.core"), F.lit(" ")).alias("flat"), F.col("p.label").alias("label"), F.explode(auds).alias("who"), "stems", "amount",
        F.floor(step).alias("low"), F.floor(step + 0.5).alias("high"), F.coalesce(seen, due, F.lit(0)).cast("long").alias("at"), F.coalesce(seen, F.lit(0)).cast("long").alias("paid_at"),
    ).select("*", F.posexplode("stems").alias("nth", "stem"))
    named, dated, paid = F.length("flat") > 0, F.col("deadline").isNotNull(), F.col("amount").isNotNull()
    near = range(-1, 2) if wide else range(1)

    def key(kind: str, *of, when: Column) -> Column:
        return F.when(when, F.xxhash64(F.lit(kind), "who.how", "who.aud", *of))

    keys = [
        *[key("p", "stem", F.col("at") + k, F.substring("flat", 1, 4), when=named) for k in near],
        *[key("s", "stem", F.col("at") + k, F.substring("flat", -4, 4), when=named) for k in near],
        key("d", "stem", "deadline", when=dated),
        key("l", "stem", F.substring("label", 1, 4), when=F.col("label") != ""),
        key("i", "flat", "deadline", when=named & dated & (F.col("nth") == 0)),
    ]
    for lack, has in (("lacks", F.lit(True) if wide else ~named), ("whole", ~named if wide else named)):
        for k in near:
            at = [F.lit(lack), "stem", F.col("paid_at") + k]
            keys += [key("a", *at, "low", when=paid & has), key("a", *at, "high", when=paid & has & ~F.col("low").eqNullSafe(F.col("high")))]
    return rows.select("id", F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL")


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b: pairs that share a blocking key, each once.

    Rows that name an audience meet those that name the same; a row that names none meets all, on keys
    without audience. Rows without issuer meet all on keys of the amount. A row has so many keys that neither
    side may be sent whole through the driver, whatever the planner takes its size for: the join is told to shuffle.
    """
    keyed = _keys(right, True).withColumnRenamed("id", "b").hint("merge")
    return _keys(left, False).withColumnRenamed("id", "a").join(keyed, "key").select("a", "b").distinct()


def votes(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b and a vote of each of FUNCTIONS: 1 match, -1 no match, 0 nothing."""
    words = F.split(F.regexp_replace("place", r"[^\p{L}]+", " "), " ")

    def side(rows: DataFrame, by: str) -> DataFrame:
        said = [F.array_join(f"p.{c}", " ").alias(c) if c in ("theme", "audience") else F.col(f"p.{c}").alias(c) for c in (*_SAID, "year", "line")]
        rows = rows.select("id", *said, "deadline", "amount", "seen", "place", words.alias("words"))
        return rows.select([F.col(c).alias(by + c) for c in rows.columns])

    l, r = side(left, "l_").drop("l_place", "l_words"), side(right, "r_")
    joined = pairs.join(l.hint("merge"), F.col("a") == F.col("l_id")).join(r.hint("merge"), F.col("b") == F.col("r_id"))

    def three(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    days = F.abs(F.datediff("l_deadline", "r_deadline"))
    ratio = F.greatest("l_amount", "r_amount") / F.least("l_amount", "r_amount")
    apart = F.abs(F.col("l_seen") - F.col("r_seen"))
    ly, ry = F.col("l_year"), F.col("r_year")
    known = F.col("r_place").isNotNull() & (F.col("r_place") != "nazionale") & (F.length("l_core") > 0)
    due, worth = three(days <= 1, days > 50), three(ratio <= 1.045, ratio > 1.1)
    return joined.withColumn("t", _text_votes(*[by + c for by in ("l_", "r_") for c in _SAID])).select(
        "a", "b", "t.theme", "t.audience", "t.issuer", due.alias("deadline"), worth.alias("amount"),
        three((ly == ry) & (ly != ""), (ly != ry) & (ly != "") & (ry != "")).alias("year"),
        three((F.col("l_line") == F.col("r_line")) & (F.col("l_line") != ""), (F.col("l_line") != F.col("r_line")) & (F.col("l_line") != "") & (F.col("r_line") != "")).alias("line"),
        "t.label",
        three(apart <= 75, apart > 150).alias("time"),
        three(known & F.arrays_overlap("r_words", F.split("l_core", " ")), known & (F.levenshtein(F.col("r_place"), F.col("l_core")) > 3)).alias("place"),
        # deadline and amount as one: by chance they agree together far more rarely than the keys make each agree
        three((due == 1) & (worth == 1), (due == -1) & (worth == -1)).alias("terms"),
    )


class LabelModel:
    """Generative model of the votes: a tree of dependences among the functions for each class, fitted by EM."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 40):
        self.k = patterns.shape[1]
        x, n = patterns + 1, counts.astype(float)
        # start from a weighed majority: what candidates are found by anyway says little, what tells calls apart says most
        y = 1 / (1 + np.exp(-self._expected(patterns)))
        self.parent = np.full(self.k, -1)
        for turn in range(rounds):
            if turn in (3, 12):
                self.parent = self._tree(x, n, y)
            self.prior = float(np.clip((n * y).sum() / max(n.sum(), 1), 1e-6, 0.95))
            self.tables = [[self._table(x, n * w, f) for f in range(self.k)] for w in (1 - y, y)]
            new = self.posterior(patterns)
            if turn > 14 and np.abs(new - y).max(initial=0) < 1e-5:
                break
            y = new

    @staticmethod
    def _expected(patterns: np.ndarray) -> np.ndarray:
        """Log odds that the functions' expected accuracies give; what is learnt is averaged with them, so that the classes keep their meaning."""
        return 2.0 * ((patterns == 1) @ START[0] - (patterns == -1) @ START[1] - START_AT)

    def _table(self, x: np.ndarray, w: np.ndarray, f: int) -> np.ndarray:
        """P(vote of f | vote of its parent), smoothed."""
        p = self.parent[f]
        t = np.full((3, 3), 0.0)
        np.add.at(t, (x[:, p] if p >= 0 else np.zeros(len(x), int), x[:, f]), w)
        alone = np.bincount(x[:, f], weights=w, minlength=3) + 0.5
        alone /= alone.sum()
        t = t + 5 * alone
        return t / t.sum(1, keepdims=True)

    def _tree(self, x: np.ndarray, n: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Maximum spanning tree of the mutual information of votes within the classes."""
        k = self.k
        info = np.zeros((k, k))
        for w in (n * (1 - y), n * y):
            total = w.sum()
            if total < 1:
                continue
            for i in range(k):
                for j in range(i):
                    joint = np.bincount(x[:, i] * 3 + x[:, j], weights=w, minlength=9).reshape(3, 3) / total
                    outer = joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)
                    ok = joint > 0
                    info[i, j] += (joint[ok] * np.log(joint[ok] / outer[ok])).sum() * total / n.sum()
                    info[j, i] = info[i, j]
        parent = np.full(k, -1)
        inside, gain = {0}, info[0].copy()
        source = np.zeros(k, int)
        while len(inside) < k:
            rest = [i for i in range(k) if i not in inside]
            best = max(rest, key=lambda i: gain[i])
            if gain[best] > 0.005:
                parent[best] = source[best]
            inside.add(best)
            for i in rest:
                if info[best, i] > gain[i]:
                    gain[i], source[i] = info[best, i], best
        return parent

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        x = patterns + 1
        logs = []
        for c in (0, 1):
            s = np.full(len(x), np.log(self.prior if c else 1 - self.prior))
            for f in range(self.k):
                p = self.parent[f]
                s += np.log(self.tables[c][f][x[:, p] if p >= 0 else np.zeros(len(x), int), x[:, f]])
            logs.append(s)
        return 1 / (1 + np.exp(-np.clip(0.5 * (logs[1] - logs[0]) + 0.5 * self._expected(patterns), -50, 50)))


def link(grants: DataFrame, register: DataFrame, rates: DataFrame) -> DataFrame:
    """grant_id, reg_id, confidence, same_edition of every candidate pair. Missing attributes abstain; ids must not be null.

    A record repeated with one id is read once. Empty tables give an empty result.
    """
    spark = grants.sparkSession
    amounts = bounds_in_euro(grants, rates).where("bound = 'max'").groupBy("grant_id").agg(F.max("amount_eur").alias("amount"))
    g = grants.select("grant_id", "title", "issuer", "deadline", "found_at").where("grant_id IS NOT NULL").dropDuplicates(["grant_id"]).join(amounts, "grant_id", "left")
    r = register.select("reg_id", "title", "issuer", "deadline", "published_on", "territory", F.when(F.col("funding_max") > 0, F.col("funding_max")).alias("amount")).where("reg_id IS NOT NULL").dropDuplicates(["reg_id"])
    left, right = durable(prepared(g, "grant_id", "found_at", None)), durable(prepared(r, "reg_id", "published_on", "territory"))
    voted = durable(votes(candidates(left, right), left, right))
    # a pattern as one number, a digit of base 3 a function
    pattern = functools.reduce(Column.__add__, [(F.col(f) + 1) * 3**k for k, f in enumerate(FUNCTIONS)]).cast("long").alias("pattern")
    counted = np.array(sorted(voted.groupBy(pattern).count().collect()), np.int64)
    if not len(counted):
        return spark.createDataFrame([], "grant_id BIGINT, reg_id BIGINT, confidence DOUBLE, same_edition BOOLEAN")
    patterns = counted[:, :1] // 3 ** np.arange(len(FUNCTIONS)) % 3 - 1
    model = LabelModel(patterns, counted[:, 1])
    said = pd.DataFrame({"pattern": counted[:, 0], "confidence": model.posterior(patterns)})
    known = F.broadcast(spark.createDataFrame(said, "pattern BIGINT, confidence DOUBLE"))
    return voted.withColumn("pattern", pattern).join(known, "pattern").select(F.col("a").alias("grant_id"), F.col("b").alias("reg_id"), "confidence", (F.least("line", "year", "theme") >= 0).alias("same_edition"))


def pairs_found(linked: DataFrame) -> DataFrame:
    """grant_id, reg_id of the pairs with a confidence of at least FOUND whose theme, edition and line, where both name one, do not contradict."""
    return linked.where((F.col("confidence") >= FOUND) & F.col("same_edition")).select("grant_id", "reg_id")
