"""Best representative of each duplicate group, field by field.

Method: token-level consensus. The distinct values of a group are aligned one after the other into a profile
of columns (the heaviest first); in each column the tokens vote with their records' weights - trust of the
source, how lately it was seen, how whole the value looks - and the consensus is what wins its column. The
record whose existing value is closest to the consensus survives. Tokens are words of a description, items
of a list of requirements, and year, month and day of a deadline.

Values are grouped before they are aligned, so copies cost nothing; a group of many different values is
aligned in blocks whose profiles are aligned in turn, so that no task holds a whole group.
"""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaglio.functions.text import collapse
from vaglio.operators.components import connected_components
from vaglio.session import durable

#: Distinct values aligned in one block, and profiles in one later block.
BLOCK = 48
#: What a record's vote weighs by the trust of its source; 1 for an unknown one.
TRUST = {1: 0.5, 2: 0.7, 3: 1.0, 4: 1.4, 5: 1.8}
DEADLINE_TRUST = {1: 0.1, 2: 0.3, 3: 1.0, 4: 3.0, 5: 3.6}
#: Days in which a vote falls to 1 / e, against the group's latest record.
AGE, DEADLINE_AGE = 90.0, 25.0
#: Share of the weight that does not abstain which a token needs: leaving out is the common fault, adding is not.
PRESENT = {"description": 0.2, "requirements": 0.2, "deadline": 0.5}
#: What a value that breaks off, or a list that repeats itself, loses in closeness.
BROKEN = 0.2
#: Deadlines outside of this many days after the record was found count for nothing.
DEADLINE_DAYS = (-400, 1500)

#: What stands in place of a requirement and is none.
NO_ITEM = re.compile(r"^\W*(?:vedi .*|n\.? ?d\.?|n/?a|requisiti|requirements|nessuno|da definire|home|contatti|privacy|accedi|registrati|mappa del sito|cerca|seguici.*|area (?:stampa|riservata)|faq|chi siamo|cookie.*|menu|condividi|stampa|newsletter|avvisi|note legali|accessibilità|credits|)\W*$", re.I)
_CUT = re.compile(r"(?:…|\.\.\.|\[[^\]]{2,20}\]|\((?:segue|continua|continues)\))\s*$", re.I)


def groups(grants: DataFrame) -> DataFrame:
    """grant_id, group_id of the records that duplicate_of links, directly or not, to another existing one."""
    ids = grants.where("grant_id IS NOT NULL").select(F.col("grant_id").alias("b")).distinct()
    links = grants.where("grant_id IS NOT NULL AND duplicate_of IS NOT NULL").select(F.col("grant_id").alias("a"), F.col("duplicate_of").alias("b")).join(ids, "b", "left_semi")
    return connected_components(links.select("a", "b")).select(F.col("node").alias("grant_id"), F.col("component").alias("group_id"))


def _trust(table: dict[int, float]) -> Column:
    c = F.coalesce(F.col("trust"), F.lit(0))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[c], F.lit(1.0))


def field_values(grants: DataFrame, sources: DataFrame) -> DataFrame:
    """group_id, field, value (tokens as JSON), title, weight, grant_id: the distinct values of each group and field."""
    member = groups(grants)
    trust = F.broadcast(sources.groupBy(F.col("id").alias("source_id")).agg(F.max("trust").alias("trust")))  # one row a source
    rows = grants.select("grant_id", "source_id", "title", "description", "requirements", "deadline", F.col("found_at").cast("date").alias("found"), F.col("last_seen_at").cast("timestamp").alias("seen"))
    rows = rows.join(member, "grant_id").join(trust, "source_id", "left")
    latest = rows.groupBy("group_id").agg(F.max("seen").alias("latest"))
    rows = rows.join(latest, "group_id").withColumn("age", F.coalesce((F.unix_timestamp("latest") - F.unix_timestamp("seen")) / 86400.0, F.lit(365.0)))
    weight, late = _trust(TRUST) * F.exp(-F.col("age") / AGE), _trust(DEADLINE_TRUST) * F.exp(-F.col("age") / DEADLINE_AGE)
    items = F.transform("requirements", lambda x: collapse(F.coalesce(x, F.lit(""))))
    days = F.datediff("deadline", "found")
    known = F.col("deadline").isNotNull() & F.year("deadline").between(2000, 2090) & (F.col("found").isNull() | days.between(*DEADLINE_DAYS))
    pairs = F.array(
        F.struct(F.lit("description").alias("field"), F.to_json(F.array(collapse(F.col("description")))).alias("value"), weight.alias("weight"), (F.length(collapse(F.col("description"))) > 0).alias("ok")),
        F.struct(F.lit("requirements").alias("field"), F.to_json(items).alias("value"), weight.alias("weight"), (F.size("requirements") > 0).alias("ok")),
        F.struct(F.lit("deadline").alias("field"), F.to_json(F.array(F.col("deadline").cast("string"))).alias("value"), late.alias("weight"), known.alias("ok")),
    )
    return (
        rows.select("group_id", "grant_id", "title", F.explode(pairs).alias("f"))
        .where("f.ok")
        .groupBy("group_id", "f.field", "f.value")
        .agg(F.max("title").alias("title"), F.sum("f.weight").alias("weight"), F.min("grant_id").alias("grant_id"))
    )


def tokens_of(field: str, value: str, title: str | None) -> tuple[list[str], bool, float]:
    """Tokens, whether the value breaks off or repeats itself, and how good it looks (1 at best)."""
    raw = json.loads(value)
    if field == "deadline":
        return raw[0].split("-"), False, 1.0
    if field == "requirements":
        items = [x.lower() for x in raw]
        good = [x for x in items if not NO_ITEM.match(x)]
        if not good:
            return items, False, 0.01
        again = len(set(good)) < len(good)
        return list(dict.fromkeys(good)), again or any(_CUT.search(x) for x in good), (1.0 if len(good) == len(items) else 0.5) * (0.3 if again else 1.0)
    text = raw[0]
    cut = _CUT.search(text) is not None or text[-1:] not in ".!?»\")"
    words = re.findall(r"\w+|[^\w\s]+", text.lower())
    about = {w for w in re.findall(r"[^\W\d_]{4,}", (title or "").lower())} - {"avviso", "bando", "pubblico", "misura", "voucher", "contributi", "incentivi", "agevolazioni", "sostegno", "edizione", "anno"}
    quality = 1.0
    if about and len(about & set(words)) < 0.34 * len(about):
        quality = 0.02  # not about the call
    if ".." in text and not text.endswith(".."):
        quality *= 0.4  # another text was glued on
    return words, cut, quality * (0.5 if cut else 1.0)


class Profile:
    """Columns of token votes. Weight that abstains from a column is that of values which break off before it."""

    def __init__(self) -> None:
        self.columns: list[dict[str, float]] = []
        self.silent: list[float] = []
        self.total = 0.0

    def heads(self) -> list[str]:
        return [max(c.items(), key=lambda kv: (kv[1], kv[0]))[0] for c in self.columns]

    def add(self, votes: list[dict[str, float]], silent: list[float], weight: float, cut: bool) -> None:
        """Align columns of another profile (a single value has one token a column) into this one."""
        if not self.columns:
            self.columns, self.silent, self.total = [dict(v) for v in votes], list(silent), weight
            return
        mine = self.heads()
        theirs = [max(v.items(), key=lambda kv: (kv[1], kv[0]))[0] for v in votes]
        columns: list[dict[str, float]] = []
        quiet: list[float] = []
        joined = -1  # the last of my columns that the other has a token for
        operations = difflib.SequenceMatcher(None, mine, theirs, autojunk=False).get_opcodes()
        for tag, a, b, c, d in operations:
            if tag in ("equal", "replace"):
                joined = a + min(b - a, d - c) - 1
        for tag, a, b, c, d in operations:
            k = min(b - a, d - c)
            for i in range(k):
                column = self.columns[a + i]
                for t, w in votes[c + i].items():
                    column[t] = column.get(t, 0.0) + w
                columns.append(column)
                quiet.append(self.silent[a + i] + silent[c + i])
            for i in range(a + k, b):
                columns.append(self.columns[i])
                quiet.append(self.silent[i] + (weight if cut and i > joined else 0.0))
            for j in range(c + k, d):
                columns.append(dict(votes[j]))
                quiet.append((quiet[-1] if quiet else 0.0) if not silent[j] else silent[j])
        self.columns, self.silent = columns, quiet
        self.total += weight

    def consensus(self, share: float) -> list[str]:
        out = []
        for column, quiet in zip(self.columns, self.silent):
            token, w = max(column.items(), key=lambda kv: (kv[1], kv[0]))
            if w >= share * (self.total - quiet) - 1e-12:
                out.append(token)
        return out

    def dump(self) -> str:
        return json.dumps([self.columns, self.silent, self.total])

    @classmethod
    def load(cls, s: str) -> Profile:
        p = cls()
        p.columns, p.silent, p.total = json.loads(s)
        return p


def profile_of(field: str, values: list[tuple[str, str | None, float]]) -> Profile:
    """The profile of values with their titles and weights; heavier and longer ones first."""
    ready = [(*tokens_of(field, v, t), w) for v, t, w in values]
    ready.sort(key=lambda r: (-r[2] * r[3], -len(r[0]), r[0]))
    p = Profile()
    for words, cut, quality, w in ready:
        p.add([{x: w * quality} for x in words], [0.0] * len(words), w * quality, cut)
    return p


def closeness(field: str, value: str, title: str | None, agreed: list[str]) -> float:
    words, cut, quality = tokens_of(field, value, title)
    if not words and not agreed:
        return 1.0
    matched = sum(m.size for m in difflib.SequenceMatcher(None, words, agreed, autojunk=False).get_matching_blocks())
    return round(2 * matched / (len(words) + len(agreed)), 9) - (0.0 if quality > 0.05 else 1.0) - (BROKEN if cut else 0.0)


def _best(field: str, values: list[tuple[str, str | None, float, int]], agreed: list[str]) -> tuple[float, float, int]:
    """Closeness, weight and grant_id of the value closest to what is agreed."""
    return max(((closeness(field, v, t, agreed), round(w, 9), g) for v, t, w, g in values), key=lambda r: (r[0], r[1], -r[2]))


def survivors(grants: DataFrame, sources: DataFrame) -> DataFrame:
    """group_id, field, grant_id, closeness: the record whose value survives, for each group of two or more.

    Null and blank values, and impossible deadlines, stand for nothing: a field that no record of a group
    holds gives no row, nor does one where all values are placeholders. Values are equal if they are but for
    white space; of several records with the surviving value the smallest grant_id is named.
    """
    values = durable(field_values(grants, sources))
    sizes = values.groupBy("group_id", "field").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = values.join(sizes, ["group_id", "field"]).withColumn("block", F.pmod(F.xxhash64("value"), F.col("blocks")).cast("int"))
    rows = blocked.groupBy("group_id", "field", "blocks", "block").agg(F.collect_list(F.struct("value", "title", "weight", "grant_id")).alias("values"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for group, field, blocks, block, held in zip(batch["group_id"], batch["field"], batch["blocks"], batch["block"], batch["values"]):
                mine = [(v["value"], v["title"], float(v["weight"]), int(v["grant_id"])) for v in held]
                p = profile_of(field, [m[:3] for m in mine])
                if blocks == 1:
                    near, _, grant = _best(field, mine, p.consensus(PRESENT[field]))
                    out.append((group, field, block, None, near, grant))
                else:
                    out.append((group, field, block, p.dump(), None, None))
            yield pd.DataFrame(out, columns=["group_id", "field", "block", "profile", "closeness", "grant_id"]).astype({"block": "int64", "grant_id": "Int64", "closeness": "float64"})

    schema = "group_id BIGINT, field STRING, block BIGINT, profile STRING, closeness DOUBLE, grant_id BIGINT"
    aligned = durable(rows.mapInPandas(align, schema))
    small = aligned.where("profile IS NULL").select("group_id", "field", "grant_id", "closeness")
    profiles = aligned.where("profile IS NOT NULL").select("group_id", "field", "block", "profile")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for group, field, block, held in zip(batch["group_id"], batch["field"], batch["block"], batch["profiles"]):
                loaded = sorted((Profile.load(s) for s in held), key=lambda p: (-p.total, json.dumps(p.columns)))
                first = loaded[0]
                for p in loaded[1:]:
                    first.add(p.columns, p.silent, p.total, False)
                out.append((group, field, block, first.dump()))
            yield pd.DataFrame(out, columns=["group_id", "field", "block", "profile"])

    most = sizes.agg(F.max("blocks")).first()[0] or 1
    if most == 1:
        return small.where(F.col("closeness") > -0.5)
    while most > 1:
        together = profiles.groupBy("group_id", "field", F.floor(F.col("block") / BLOCK).alias("block")).agg(F.collect_list("profile").alias("profiles"))
        profiles = durable(together.mapInPandas(merge, "group_id BIGINT, field STRING, block BIGINT, profile STRING"))
        most = -(-most // BLOCK)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (group, field, grant, round(weight, 9), closeness(field, value, title, list(agreed)))
                for group, field, value, title, weight, grant, agreed in batch[["group_id", "field", "value", "title", "weight", "grant_id", "agreed"]].itertuples(index=False)
            ]
            yield pd.DataFrame(out, columns=["group_id", "field", "grant_id", "weight", "closeness"])

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["agreed"] = [Profile.load(s).consensus(PRESENT[f]) for s, f in zip(batch["profile"], batch["field"])]
            yield batch[["group_id", "field", "agreed"]]

    # each large group's consensus, which is no longer than a value, is worked out once and goes to its values
    agreed = profiles.select("group_id", "field", "profile").mapInPandas(settle, "group_id BIGINT, field STRING, agreed ARRAY<STRING>")
    wide = values.join(agreed, ["group_id", "field"]).mapInPandas(near, "group_id BIGINT, field STRING, grant_id BIGINT, weight DOUBLE, closeness DOUBLE")
    best = wide.groupBy("group_id", "field").agg(F.max(F.struct("closeness", "weight", -F.col("grant_id"), "grant_id")).alias("m"))
    return small.unionByName(best.select("group_id", "field", "m.grant_id", "m.closeness")).where(F.col("closeness") > -0.5)
