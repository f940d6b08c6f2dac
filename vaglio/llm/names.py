"""Variant spellings of names typed by people.

Method: a spelling is folded, its abbreviations, kinds of body and nicknames are read, and what is left is
its core. Equal forms fall together first. The cores' padded q-grams are MinHashed and banded, with as many
bands as the collision curve asks for at the similarity where recall is wanted; colliding forms of one kind
are verified by Monge-Elkan similarity; star clustering makes the links into entities: the best supported
form of a neighbourhood becomes a centre and takes the weaker forms beside it, never a form that is itself
well supported, so that two bodies of like names do not merge.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaglio.functions.distance import jaro_winkler, weighted_edit
from vaglio.llm.leakage import fold
from vaglio.session import durable

Q = 2
ROWS = 3
#: Jaccard similarity of q-grams at which the share RECALL of pairs must collide in some band.
SIMILAR = 0.45
RECALL = 0.98
#: Bands, from the collision curve 1 - (1 - s^r)^b.
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - SIMILAR**ROWS))
#: Monge-Elkan similarity of two forms of one entity.
VERIFIED = 0.83
#: A form joins a centre if the centre's core is in so many times as many spellings.
SUPPORT = 4
#: Rounds of the star clustering after which what was taken becomes one table again.
FOLD = 16
#: Letters of a core from which a slip or two cannot lead to another body's name.
LONG = 14

#: Words and abbreviations that tell the kind of body.
KINDS = {
    "fondazione": "fondazione fond fne foundation stiftung",
    "gal": "gal",
    "bonifica": "bonifica cdb",
    "camera": "cciaa",
    "parco": "parco epn",
    "universita": "universita univ ateneo university universitat",
    "provincia": "provincia provinciale prov",
    "regione": "regione regionale reg regne giunta",
    "comune": "comune comunale com citta municipio",
}
#: Words that say nothing once the kind is known.
FILLERS = set("gruppo azione locale terre consorzio cons camera commercio cam comm industria artigianato agricoltura iaa ente naturale nat amministrazione ammne studi st degli terra".split())
STOP = set("di del della dei delle dello dell d l il lo la le gli i e ed per ai al alla agli a of the and und der de da in su".split())
#: What may follow a name, from here to the end of its part.
TAILS = set("settore dip dipartimento ufficio direzione assessorato area servizio".split())
LEGAL = set("ets onlus spa srl scarl scrl sc rl sca aps odv ente".split())
#: Short forms and other languages' words, by what they stand for.
SHORT = {
    "min": "ministero", "ist": "istituto", "ag": "agenzia", "naz": "nazionale", "eur": "europeo", "eu": "europeo", "european": "europeo",
    "europea": "europeo", "programme": "programma", "program": "programma", "prog": "programma", "autonome": "autonoma", "aut": "autonoma",
    "provinz": "provincia", "union": "unione", "interprovle": "interprovinciale", "ass": "associazione", "fed": "federazione", "cons": "consorzio",
}
#: Pet names by given name.
NICKNAMES = {
    "gianni": "giovanni", "nanni": "giovanni", "vanni": "giovanni", "beppe": "giuseppe", "peppe": "giuseppe", "pino": "giuseppe", "gigi": "luigi", "gino": "luigi",
    "nino": "antonio", "tonino": "antonio", "toni": "antonio", "totò": "salvatore", "toto": "salvatore", "turi": "salvatore", "mimmo": "domenico", "enzo": "vincenzo",
    "lello": "raffaele", "lele": "raffaele", "rina": "caterina", "cati": "caterina", "franca": "francesca", "lena": "maddalena", "betta": "elisabetta", "lisa": "elisabetta",
    "sandro": "alessandro", "nando": "ferdinando", "pippo": "filippo", "cecco": "francesco", "checco": "francesco", "ciccio": "francesco", "tina": "concetta", "berto": "alberto",
}
GIVEN = sorted(set(NICKNAMES.values()) | {"maria", "anna", "paolo", "pietro", "marco", "carlo", "mario", "lucia", "teresa", "rosa", "angela", "giulia", "michele", "stefano", "roberto", "andrea", "matteo", "chiara", "laura", "silvia"})

_VOCABULARY = sorted({w for ws in KINDS.values() for w in ws.split() if len(w) > 4} | {w for w in FILLERS | set(SHORT.values()) | TAILS if len(w) > 4} | {"attivita", "produttive", "autonoma", "cciaa"})


def _near(word: str, vocabulary: list[str] | tuple[str, ...]) -> str | None:
    """The word of the vocabulary that word is a slip of: cost 1 at most, 2 from nine letters on."""
    best, least = None, 9.0
    for v in vocabulary:
        limit = 2.0 if len(v) >= 9 else 1.0
        if abs(len(v) - len(word)) <= limit + 0.5 and len(set(v) & set(word)) >= len(set(v)) - 2:
            cost = weighted_edit(word, v)
            if cost <= limit and cost < least:
                best, least = v, cost
    return best


@functools.lru_cache(maxsize=200_000)
def _known_word(word: str) -> str:
    if word in STOP or word in SHORT or word in _VOCABULARY or len(word) < 4:
        return word
    return _near(word, _VOCABULARY) or word


@functools.lru_cache(maxsize=200_000)
def _given(word: str) -> str | None:
    """The given name that word is, in full."""
    if word in NICKNAMES:
        return NICKNAMES[word]
    if word in GIVEN:
        return word
    if len(word) < 4:
        return None
    near = _near(word, GIVEN)
    if near:
        return near
    near = _near(word, sorted(NICKNAMES)) if len(word) >= 5 else None
    return NICKNAMES[near] if near else None


def parse_name(name: str | None) -> tuple[str, str, str, str]:
    """Kind, core (its words as typed; sorted for bodies of no known kind), given name or initial, and the core as typed and closed up.

    Null and blank names have the kind 'empty'.
    """
    text = fold(name or "").replace("’", "'").strip()
    if not text:
        return "empty", "", "", ""
    text = text.replace("&", " e ")
    text = re.sub(r"\b(?:[a-z]\.\s?){2,}(?=$|[\s,)\-]|[a-z]\b\.?)", lambda m: re.sub(r"[.\s]", "", m[0]) + " ", text) if re.search(r"\b[a-z]\.\s?[a-z]\.", text) else text
    text = re.sub(r"(?<=[a-z])\.(?=[a-z])", "", text)
    text = re.sub(r"(?<=\w)-(?=\w)", "", text)
    words: list[str] = []
    for part in re.split(r"[,()\-–|]", text):
        own = []
        for w in re.findall(r"[^\W_]+", part):
            w = _known_word(SHORT.get(w, w))
            if w in TAILS and (own or words):
                break
            own.append(w)
        words += own
    closed = re.sub(r"[^\w]|_", "", text)
    bare = set(words)
    kind = next((k for k, ws in KINDS.items() if bare & set(ws.split())), None)
    if len(bare & {"gruppo", "azione", "locale"}) >= 2:
        kind = "gal"
    elif len(bare & {"camera", "commercio", "cam", "comm"}) >= 2:
        kind = "camera"
    if kind is None and words and words[0] == "r" and len(words) > 1:
        kind = "regione"
    if kind in (None, "provincia") and ("autonoma" in bare or "land" in bare or (words[:1] == ["pa"] and len(words) > 1)):
        kind = "autonoma"
    if kind == "regione" and "autonoma" in bare:
        bare.discard("autonoma")
    if kind == "comune" and "unione" in bare:
        kind = None
    drop = STOP | LEGAL
    if kind:
        drop = drop | FILLERS | {w for ws in KINDS.values() for w in ws.split()} | {"autonoma", "land", "pa", "r", "attivita", "produttive"}
    core = [w for w in words if w not in drop]
    if kind is None and len(core) == 1 and core[0].startswith("uni") and len(core[0]) >= 9 and not core[0].startswith("unione") and not core[0].startswith("unionc"):
        kind, core = "universita", [core[0][3:]]
    elif kind is None and len(core) == 1 and re.fullmatch(r"u(ii|in|nii|n|i)[a-z]{6,}", core[0]) and re.match(r"U\w{0,3}[A-Z]", (name or "").strip()):
        kind, core = "universita", [re.sub(r"^u(nii|ii|in|n|i)", "", core[0])]
    given = ""
    if kind == "fondazione" and len(core) > 1:
        named = [w for w in core if len(w) == 1] or [w for w in core if _given(w)]
        if named:
            given = named[0] if len(named[0]) == 1 else _given(named[0]) or ""
            core = [w for i, w in enumerate(core) if i != core.index(named[0])]
    if not core:
        core = [w for w in words if w not in STOP] or [closed]
    joined = "".join(core)
    return kind or "other", " ".join(core if kind else sorted(core)), given, joined


@functools.lru_cache(maxsize=200_000)
def _like_word(p: str, q: str) -> float:
    if p == q:
        return 1.0
    n = max(len(p), len(q))
    cost = weighted_edit(p, q, 2 if n >= 8 else 1)
    return 0.0 if n < 4 or cost > (2 if n >= 8 else 1) else min(1 - cost / n, jaro_winkler(p, q) + 0.05)


def monge_elkan(a: str, b: str) -> float:
    """Mean over the words of each side of their best match on the other, the lower side; words closed up count too."""
    x, y = a.split(), b.split()
    if not x or not y:
        return 0.0
    one = sum(max(_like_word(p, q) for q in y) * len(p) for p in x) / sum(map(len, x))
    two = sum(max(_like_word(p, q) for q in x) * len(p) for p in y) / sum(map(len, y))
    joined = _like_word("".join(x), "".join(y)) if len(x) != len(y) else 0.0
    return max(min(one, two), joined)


def is_acronym(short: str, words: list[str]) -> bool:
    """Whether short is made of beginnings of all the words, in order."""

    @functools.cache
    def fits(i: int, k: int) -> bool:
        if k == len(words):
            return i == len(short)
        return any(words[k].startswith(short[i:j]) and fits(j, k + 1) for j in range(i + 1, min(len(short), i + 4) + 1))

    return len(words) >= 2 and fits(0, 0)


_FORM = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "core", "given", "closed")])


@F.pandas_udf(_FORM)
def _parse(names: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_name(n) for n in names], columns=["kind", "core", "given", "closed"])


@F.pandas_udf(T.DoubleType())
def _similar(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([monge_elkan(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.BooleanType())
def _acronym(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([is_acronym(x, [w for w in re.findall(r"[^\W_]+", y) if w not in STOP]) for x, y in zip(a, b)], dtype="bool")


def _signature(count: int):
    """MinHashes of the padded q-grams of a core, closed up."""
    numbers = np.random.default_rng(11)
    a = numbers.integers(1, 2**61 - 1, count, dtype=np.uint64) | np.uint64(1)
    b = numbers.integers(0, 2**61 - 1, count, dtype=np.uint64)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def sign(cores: pd.Series) -> pd.Series:
        out = []
        for core in cores:
            padded = f"^{core.replace(' ', '')}$"
            grams = {padded[i : i + Q] for i in range(len(padded) - Q + 1)}
            x = np.array([hash_of(g) for g in sorted(grams)], np.uint64)
            h = x[:, None] * a + b
            h ^= h >> np.uint64(31)
            out.append((h * np.uint64(0x9E3779B97F4A7C15)).min(0).view(np.int64))
        return pd.Series(out)

    return sign


def hash_of(gram: str) -> int:
    h = 1469598103934665603
    for ch in gram:
        h = ((h ^ ord(ch)) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return h


def forms_of(spellings: DataFrame) -> DataFrame:
    """spelling_id, form (its number), kind, core, given, closed of each spelling."""
    # few bytes and much to do with each: a small file's one partition is spread first
    parsed = spellings.repartition(spellings.sparkSession.sparkContext.defaultParallelism).select("spelling_id", _parse("issuer").alias("p"), "issuer").select("spelling_id", "issuer", "p.*").where("kind <> 'empty'")
    return parsed.withColumn("form", F.xxhash64("kind", "core", "given"))


def _banded(forms: DataFrame) -> DataFrame:
    """a, b: pairs of forms that collide in a band, smaller number first, each once.

    The planner takes exploded bands for no more than the forms they come from, and the forms for no more than
    their compressed file; so this join and those below are told to shuffle, and nothing but what is measured to be
    small goes through the driver.
    """
    signed = forms.withColumn("s", _signature(BANDS * ROWS)("closed"))
    bands = F.array(*[F.xxhash64("kind", F.lit(k), *[F.col("s")[k * ROWS + j] for j in range(ROWS)]) for k in range(BANDS)])
    keyed = signed.select("form", F.explode(bands).alias("key"))
    left, right = keyed.withColumnRenamed("form", "a"), keyed.withColumnRenamed("form", "b")
    return left.join(right.hint("merge"), "key").where(F.col("a") < F.col("b")).select("a", "b").distinct()


def links_of(forms: DataFrame, typed: DataFrame) -> DataFrame:
    """a, b, similarity, loose of verified links between forms; loose ones do not ask for support.

    forms: one row a form; typed: form, typed of each spelling of no known kind. Loose links are a given name's initial or absence, long cores, and acronyms.
    """
    met = _banded(forms)
    for end in ("a", "b"):
        met = met.join(forms.select(F.col("form").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("core", "given", "closed")]).hint("merge"), end)
    same_given = F.col("given_a") == F.col("given_b")
    initial = (F.length("given_a") <= 1) | (F.length("given_b") <= 1)
    fits = F.when(F.length("given_a") <= 1, F.col("given_b").startswith(F.col("given_a"))).otherwise(F.col("given_a").startswith(F.col("given_b")))
    long = (F.least(F.length("closed_a"), F.length("closed_b")) >= LONG) & (F.col("similarity") >= 0.88)
    verified = (
        met.where(same_given | (initial & fits))
        .withColumn("similarity", F.when((F.col("core_a") == F.col("core_b")) | (F.col("closed_a") == F.col("closed_b")), F.lit(1.0)).otherwise(F.greatest(_similar("core_a", "core_b"), _similar("closed_a", "closed_b"))))
        .where(F.col("similarity") >= VERIFIED)
        .select("a", "b", "similarity", ((initial & ~same_given & (F.col("core_a") == F.col("core_b"))) | long).alias("loose"))
    )
    other = forms.where(F.col("kind") == "other")
    short = other.where(~F.col("core").contains(" ") & F.length("closed").between(2, 9)).select(F.col("form").alias("b"), "closed")
    ends = F.transform(F.sequence(F.lit(2), F.length("closed")), lambda i: F.concat(F.substring("closed", 1, 1), F.substring(F.col("closed"), i, F.lit(1))))
    words = F.filter(F.split(F.regexp_replace(F.lower("typed"), r"[^\p{L}]+", " "), " "), lambda w: (w != "") & ~w.isin(*STOP))
    full = typed.select(F.col("form").alias("a"), "typed", words.alias("w")).where(F.size("w") >= 2)
    full = full.select("a", "typed", F.concat(F.substring(F.col("w")[0], 1, 1), F.substring(F.element_at("w", -1), 1, 1)).alias("ends"))
    acronyms = (
        short.select("b", "closed", F.explode(F.array_distinct(ends)).alias("ends"))
        .join(full.hint("merge"), "ends")
        .where(_acronym("closed", F.lower("typed")))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(0.95).alias("similarity"), F.lit(True).alias("loose"))
    )
    return verified.unionByName(acronyms).groupBy("a", "b").agg(F.max("similarity").alias("similarity"), F.max("loose").alias("loose"))


def star_clusters(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """node, centre. nodes: node, rank (distinct, higher first); links: a, b, similarity.

    In each round the nodes that outrank all their open neighbours become centres and take those; links of
    taken nodes are dropped. It ends when no link is left: the highest open node is a centre in each round,
    and the rounds grow with the longest chain of falling rank.
    """
    ranked = nodes.select("node", "rank")
    both = links.select("a", "b", "similarity").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity"))
    left = durable(
        both.join(ranked.withColumnsRenamed({"node": "a", "rank": "ra"}).hint("merge"), "a").join(ranked.withColumnsRenamed({"node": "b", "rank": "rb"}).hint("merge"), "b")
    )
    taken = None
    rounds = 0
    while not left.isEmpty():
        top = left.groupBy("a").agg(F.max("rb").alias("best"), F.first("ra").alias("ra")).where("ra > best").select(F.col("a").alias("centre"))
        got = (
            left.join(top, left["a"] == top["centre"])
            .groupBy(F.col("b").alias("node"))
            .agg(F.max(F.struct("similarity", "ra", "centre")).alias("m"))
            .select("node", F.col("m.centre").alias("centre"))
        )
        got = durable(got)
        taken = got if taken is None else taken.unionByName(got)
        rounds += 1
        if rounds % FOLD == 0:
            taken = durable(taken)
        gone = got.select("node").unionByName(got.select(F.col("centre").alias("node"))).distinct()
        left = durable(left.join(gone, left["a"] == gone["node"], "left_anti").join(gone, left["b"] == gone["node"], "left_anti"))
    if taken is None:
        return ranked.select("node", F.col("node").alias("centre"))
    return ranked.join(taken, "node", "left").select("node", F.coalesce("centre", "node").alias("centre"))


def entities(spellings: DataFrame) -> DataFrame:
    """spelling_id, entity: the number of the star's centre. Null and blank spellings are left out."""
    forms = durable(forms_of(spellings.dropDuplicates(["spelling_id"])))
    support = forms.groupBy("core").agg(F.count("*").alias("support"))
    nodes = forms.groupBy("form").agg(
        F.first("kind").alias("kind"), F.first("core").alias("core"), F.first("given").alias("given"), F.min("closed").alias("closed"),
        F.count("*").alias("weight"),
    )
    nodes = durable(nodes.join(support.hint("merge"), "core"))
    links = links_of(nodes, forms.where((F.col("kind") == "other") & F.col("core").contains(" ")).select("form", F.col("issuer").alias("typed")))
    of = nodes.select(F.col("form"), "support", "weight", (F.length("given") > 1).alias("full"))
    a = of.withColumnsRenamed({"form": "a", "support": "sa", "weight": "wa", "full": "fa"})
    b = of.withColumnsRenamed({"form": "b", "support": "sb", "weight": "wb", "full": "fb"})
    weaker, stronger = F.least("sa", "sb"), F.greatest("sa", "sb")
    kept = durable(links.join(a.hint("merge"), "a").join(b.hint("merge"), "b").where(F.col("loose") | (weaker <= 1) | (weaker * SUPPORT <= stronger)).select("a", "b", "similarity"))
    rank = nodes.select(F.col("form").alias("node"), F.struct((F.length("given") != 1).alias("g"), F.col("core").contains(" ").alias("w"), "support", "weight", F.col("form").alias("f")).alias("rank"))
    stars = star_clusters(rank, kept)
    return forms.hint("merge").join(stars, forms["form"] == stars["node"]).select("spelling_id", F.col("centre").alias("entity"))


def same_entity_pairs(spellings: DataFrame) -> DataFrame:
    """spelling_id_a, spelling_id_b: every two spellings of one entity, the smaller number first.

    Equal strings under several numbers are linked too; a repeated row counts once; null ids do not occur.
    """
    found = durable(entities(spellings.where("spelling_id IS NOT NULL")))
    left, right = found.withColumnRenamed("spelling_id", "spelling_id_a"), found.withColumnRenamed("spelling_id", "spelling_id_b")
    return left.join(right, "entity").where("spelling_id_a < spelling_id_b").select("spelling_id_a", "spelling_id_b")
