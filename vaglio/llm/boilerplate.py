"""Page boilerplate mixed with main content.

Method: equivalence-class template deduction. The tokens of a page are its lines. Lines of one host whose
occurrence vectors over its pages agree, and that stand in the same order beside each other, make an
equivalence class; classes of at least two lines and enough pages are valid and make up the template
(navigation, footer, cookie notice, widgets). The same is done over all hosts at once, for what portals
buy in. What the template leaves are its slots: the title slot follows the top of the template, the body
slot follows the title, and slots filled with titles of other notices are lists of links.

Agreement of vectors is counted, not held: pages that hold two neighbouring lines against pages that hold
either. All counts are sums combined on the map side, so a host with a third of all pages is no hot task.
Pages fetched again count once, else a notice's own lines would look like a class.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaglio.session import durable, small_side

#: Lines that a neighbour may be apart, for template lines that a page leaves out.
REACH = 3
#: Pages that hold a class, at least; over all hosts at least ALL_PAGES.
PAGES, ALL_PAGES = 3, 6
#: Share of a line's pages on which its neighbour is there too.
AGREE = 0.4
#: The same for both lines where they need not be on a STEADY share of the host's pages.
CLOSE = 0.55
STEADY = 0.33
#: Share of titles that begin with a word, for the word to open titles.
OPENER = 0.01

#: What one-line widgets say, which form no class by themselves.
CUES = re.compile(
    r"^(?:pubblicità|annuncio|advertisement|anzeige|ascolta(?: il testo)?|leggi anche\b.*|vedi anche\b.*|read (?:also|more)\b.*|scarica l'app\b.*|hai bisogno di aiuto\b.*"
    r"|condividi(?: su .*)?|stampa|invia per e-?mail|iscriviti(?: alla newsletter)?|newsletter|torna su|torna indietro|questa pagina ti è stata utile\b.*|seguici(?: su.*)?"
    r"|salta al contenuto|mappa del sito|cookie policy|privacy(?: policy)?|note legali|credits|accedi|registrati|cerca|menu|«? ?precedente|successivo ?»?|avanti|indietro"
    r"|tutti i diritti riservati|©.*|p\. ?iva \d+|.*assistente virtuale.*|.*\bcookies?\b.{0,120}\b(?:terze parti|tecnici|preferenze)\b.*)$",
    re.I,
)
_DATE = re.compile(r"^\d{1,2}(?:\.|°)?[ /.-](?:[A-Za-zäé]+|\d{1,2})\.?[ /.-]\d{2,4}$|^\d{4}-\d{2}-\d{2}$")
_CRUMB = re.compile(r"\s(?:>|»|/|›|→)\s")


def pages_of(pages: DataFrame) -> DataFrame:
    """page_id, host, url, fetched_at, lines of each page with text."""
    host = F.lower(F.regexp_extract("url", r"(?i)^[a-z]+://([^/?#]*)", 1))
    return pages.where("page_id IS NOT NULL AND length(text) > 0").select(
        "page_id", F.when(F.coalesce(host, F.lit("")) == "", F.coalesce("source_id", F.lit(""))).otherwise(host).alias("host"),
        F.coalesce("url", F.concat(F.lit("#"), "page_id")).alias("url"), "fetched_at", F.split("text", "\n").alias("lines"),
    )


def line_key(c: Column) -> Column:
    """A line's 64-bit key: its blanks at both ends do not count."""
    return F.xxhash64(F.trim(c))


def template_lines(pages: DataFrame) -> DataFrame:
    """host ('' for all), key: the lines of valid equivalence classes. pages: as pages_of().

    Lines travel as keys of 64 bits, whatever their length. What holds over all hosts is summed from the hosts' own
    counts, so each page's lines and pairs of lines are counted once, on the map side.
    """
    once = pages.select("host", "url", "page_id", "fetched_at", F.array_distinct(F.transform(F.filter(F.transform("lines", lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.xxhash64(x))).alias("l"))
    # of a page fetched again the newest holds
    once = once.groupBy("host", "url").agg(F.max(F.struct(F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("t"), (-F.col("page_id")).alias("i"), "l")).alias("m")).select("host", "m.l")
    once = once.persist(StorageLevel.MEMORY_AND_DISK)  # lost blocks are computed again
    own = durable(once.select("host", F.explode("l").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")))
    far = F.filter(
        F.flatten(F.transform(F.sequence(F.lit(1), F.lit(REACH)), lambda k: F.arrays_zip(F.col("l").alias("a"), F.slice(F.col("l"), k + F.lit(1), F.size("l")).alias("b")))),
        lambda p: p["b"].isNotNull(),
    )
    # a pair can only count where both its lines do: on PAGES pages of the host or ALL_PAGES of all
    often = own.where(F.col("n") >= PAGES).select("key").unionByName(own.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= ALL_PAGES).select("key")).distinct()
    known, _ = small_side(durable(often.withColumnRenamed("key", "_k")), 1_000_000)
    row = F.monotonically_increasing_id()
    placed = once.select(row.alias("row"), "host", "l").select("row", "host", F.posexplode("l").alias("i", "key")).join(known, F.col("key") == F.col("_k"), "left_semi")
    kept = placed.groupBy("row", "host").agg(F.array_sort(F.collect_list(F.struct("i", "key"))).alias("l"))
    near = F.filter(far, lambda p: p["b"]["i"] - p["a"]["i"] <= REACH)
    pairs = kept.where(F.size("l") > 1).select("host", F.explode(F.transform(near, lambda p: F.struct(p["a"]["key"].alias("a"), p["b"]["key"].alias("b")))).alias("p"))
    beside = durable(pairs.groupBy("host", "p.a", "p.b").agg(F.count("*").alias("c")))
    size = once.groupBy("host").agg(F.count("*").alias("pages"))

    def valid(counts: DataFrame, together: DataFrame, least: int, steady: Column) -> DataFrame:
        often = counts.where(F.col("n") >= least)
        scored = together.where(F.col("c") >= least).join(often.withColumnsRenamed({"key": "a", "n": "na"}), ["host", "a"]).join(often.withColumnsRenamed({"key": "b", "n": "nb"}), ["host", "b"]).join(size, "host", "left")
        low, high = F.least(F.col("c") / F.col("na"), F.col("c") / F.col("nb")), F.greatest(F.col("c") / F.col("na"), F.col("c") / F.col("nb"))
        # the vectors agree closely, or both lines are on a steady part of the host's pages and the less frequent is mostly with the other
        return scored.where((low >= CLOSE) | (steady & (high >= AGREE))).select("host", F.explode(F.array("a", "b")).alias("key"))

    of_host = valid(own, beside, PAGES, F.least("na", "nb") >= STEADY * F.col("pages"))
    every = own.groupBy("key").agg(F.sum("n").alias("n")).select(F.lit("").alias("host"), "key", "n")
    every_beside = beside.groupBy("a", "b").agg(F.sum("c").alias("c")).select(F.lit("").alias("host"), "a", "b", "c")
    found = durable(of_host.unionByName(valid(every, every_beside, ALL_PAGES, F.lit(False))).distinct())
    once.unpersist()
    return found


def crumb_prefix(line: str) -> str | None:
    """The beginning of the title that a breadcrumb line ends with."""
    parts = _CRUMB.split(line)
    return parts[-1].strip().rstrip("…. ") if len(parts) >= 3 and len(parts[-1].strip()) >= 8 else None


def title_openers(pages: DataFrame) -> list[str]:
    """First words of the titles that breadcrumbs point to, of at least OPENER of them: at most 1 / OPENER words."""
    last = F.regexp_extract(F.col("x"), r"^.*\s(?:>|»|/|›|→)\s+(\S+)\s.{4,}$", 1)
    words = pages.select(F.explode(F.filter("lines", lambda x: x.rlike(r"\s(?:>|»|/|›|→)\s.*\s(?:>|»|/|›|→)\s"))).alias("x")).select(F.lower(last).alias("w")).where("w <> ''")
    counts = words.groupBy("w").count()
    total = counts.agg(F.sum("count")).first()[0]
    return sorted(r.w for r in counts.where(F.col("count") >= max(2, OPENER * (total or 0))).collect())


def furniture(lines: list[str], template: set[int], openers: frozenset[str]) -> list[int]:
    """Numbers of the lines that are not part of the page's own title and body. template: numbers of the lines that it holds."""
    bare = [x.strip() for x in lines]
    n = len(bare)
    crumb, title = -1, -1
    for i, x in enumerate(bare):
        prefix = crumb_prefix(x)
        if prefix:
            for j in range(i + 1, min(n, i + 8)):
                if bare[j].startswith(prefix):
                    crumb, title = i, j
                    break
        if title >= 0:
            break
    flagged = [bool(x) and (i in template or CUES.match(x) is not None) for i, x in enumerate(bare)]

    def opens(x: str) -> bool:
        return bool(x) and x.split(None, 1)[0].lower() in openers and not x.endswith((".", ":", ";")) and len(x) <= 200

    if title < 0:
        title = next((i for i, x in enumerate(bare) if opens(x) and not flagged[i]), -1)
    if title >= 0 and crumb < 0 and any(bare[i].endswith(".") and not flagged[i] for i in range(title)):
        title = -1  # sentences of the page's own stand before it: it is a link
    if title < 0:
        # no title is told by its words: the first line that is no template, behind the top of it
        title = next((i for i, x in enumerate(bare) if x and not flagged[i] and crumb_prefix(x) is None), n)
    out = set(range(title))
    # lists of other notices, with their dates and heading
    i = title + 1
    while i < n:
        if opens(bare[i]) and not flagged[i]:
            j = i
            while j < n and ((opens(bare[j]) and not flagged[j]) or _DATE.match(bare[j])):
                j += 1
            out.update(range(i, j))
            head = i - 1
            if head > title and bare[head] and len(bare[head]) < 45 and not bare[head].endswith((".", ":")) and not re.search(r"\d", bare[head]):
                out.add(head)
            i = j
        else:
            i += 1
    out.update(i for i in range(title + 1, n) if flagged[i])
    # behind a run of three template lines that ends the page's own part, nothing is the page's own
    run = 0
    for i in range(title + 1, n):
        run = run + 1 if flagged[i] and i in template and CUES.match(bare[i]) is None else 0
        if run == 3:
            rest = [k for k in range(i + 1, n) if k not in out]
            if len(rest) <= 0.5 * (n - i):
                out.update(rest)
                break
            run = 0
    return sorted(out)


def line_flags(pages: DataFrame) -> DataFrame:
    """page_id, host, lines, numbers (of the lines that are furniture) of each page with text.

    Which lines the template holds is found by a join on host and line key; neither is ever collected. The
    template is broadcast if it is counted to be small, else shuffled.
    """
    read = pages_of(pages)
    found = template_lines(read)
    openers = frozenset(title_openers(read))
    template, _ = small_side(found, 500_000)
    row = F.monotonically_increasing_id()
    numbered = durable(read.select(row.alias("row"), "page_id", "host", "lines"))
    keyed = numbered.select("row", "host", F.posexplode(F.transform("lines", line_key)).alias("i", "key")).select("row", "i", "key", F.explode(F.array_distinct(F.array("host", F.lit("")))).alias("host"))
    held = keyed.join(template, ["host", "key"], "left_semi").groupBy("row").agg(F.collect_set("i").alias("held"))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page, host, lines, inside in zip(batch["page_id"], batch["host"], batch["lines"], batch["held"]):
                rows.append((page, host, list(lines), furniture(list(lines), set(inside) if inside is not None else set(), openers)))
            yield pd.DataFrame(rows, columns=["page_id", "host", "lines", "numbers"])

    return numbered.join(held, "row", "left").select("page_id", "host", "lines", "held").mapInPandas(mark, "page_id BIGINT, host STRING, lines ARRAY<STRING>, numbers ARRAY<INT>")


def furniture_lines(pages: DataFrame) -> DataFrame:
    """page_id, line_no of each line that is no part of the page's own title and body.

    Null and empty texts have no lines. A blank line among the page's own is kept. Pages of hosts with fewer
    than PAGES pages have only the template of all hosts; a repeated page_id gives each number once.
    """
    return line_flags(pages).select("page_id", F.explode("numbers").alias("line_no")).distinct()


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, main: the page's own title and body; '' where nothing is left."""
    kept = F.filter(F.transform("lines", lambda x, i: F.when(~F.array_contains("numbers", i), x)), lambda x: x.isNotNull())
    return line_flags(pages).select("page_id", F.array_join(kept, "\n").alias("main"))
