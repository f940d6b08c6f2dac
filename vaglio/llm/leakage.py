"""Evaluation texts leaking into training text.

Method: q-gram lemma filtering. Texts are reduced to their letters and digits. A document is cut into
blocks of Q characters, one after the other; a passage of L characters holds at least (L + 1 - Q) / Q whole blocks
of them, and each edit spoils one, so a passage found with e edits shares at least that many less e blocks with the
item, whose q-grams are indexed at every place, all within e of one diagonal (place in the document minus place in
the item). Shared blocks are counted in overlapping bands of diagonals, and each band that meets the bound is verified by
an alignment confined to it: from its longest run of equal characters to both sides, furthest-reaching points on
each diagonal of the band, edit by edit, as long as the edits stay within EDIT_RATE. p8_found asks for ten words without
an edit; that is checked last, on what was aligned.

The items are a stated query set of fixed size: their index is built once a Python worker from the items, sent in
blocks of a checked size, and every document is read once, with no shuffle before the links are made unique.
"""

from __future__ import annotations

import functools
import html
import re
import unicodedata
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
#: Words in a row that make a leak.
WORDS = 10
#: Edits allowed in a passage, as a share of its characters.
EDIT_RATE = 0.02
#: Characters of all items together beyond which their index is not sent to executors at once but in blocks.
BLOCK_CHARS = 20_000_000
#: Documents whose blocks are looked up at once.
TOGETHER = 256

_MARKUP = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>|\]\([^()\s]*\)", re.S)
_ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
_WORD = re.compile(r"[^\W_]+")
_KEPT_SPECIAL = str.maketrans({"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ı": "i"})


_PLAIN = bytes(range(256)).lower()
_DROP = bytes(i for i in range(256) if not chr(i).isalnum() or i > 127)


@functools.lru_cache(maxsize=None)
def _invisible(c: str) -> bool:
    """Whether a character is a mark, a format character or a control, but for line ends and tabs."""
    return unicodedata.category(c) in ("Mn", "Me", "Cf", "Cc") and c not in "\n\t\r"


def fold(text: str) -> str:
    """Lower case without accents, markup, entities and invisible characters; punctuation and blanks stay."""
    if "<" in text or "](" in text:
        text = _MARKUP.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        for c in set(text):
            if c > "~" and _invisible(c):
                text = text.replace(c, "")
    text = text.casefold()
    return text if text.isascii() else text.translate(_KEPT_SPECIAL)


def letters(text: str) -> tuple[str, np.ndarray, np.ndarray]:
    """The letters and digits of text in a row, and for each whether a word starts and whether one ends there."""
    words = _WORD.findall(fold(text))
    joined = "".join(words)
    n = len(joined)
    starts, ends = np.zeros(n, bool), np.zeros(n, bool)
    if words:
        stop = np.cumsum([len(w) for w in words])
        ends[stop - 1] = True
        starts[0] = True
        starts[stop[:-1]] = True
    return joined, starts, ends


def reduced(text: str) -> bytes | None:
    """The letters and digits of text as letters() has them, if all are ASCII; else None. Fast: no word is looked at."""
    if "<" in text or "](" in text:
        text = _MARKUP.sub(" ", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        for special in {c for c in set(text) if c > "\x7f"}:
            if special.isalnum():
                plain = special.casefold().translate(_KEPT_SPECIAL)
                if not plain.isascii():
                    return None
                text = text.replace(special, plain)
        return text.encode("ascii", "ignore").translate(_PLAIN, _DROP)
    return text.encode("ascii").translate(_PLAIN, _DROP)


def codes_of(joined: str) -> np.ndarray:
    return np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)


#: What the characters of a gram are multiplied by: bytes side by side for ASCII texts, a hash for the others.
_BYTES = np.array([1 << (8 * k) for k in range(Q)], np.uint64)
_HASH = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(Q)], np.uint64)


def grams_of(codes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """A 64-bit code of each run of Q characters; equal runs have equal codes."""
    n = len(codes) - Q + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(Q if n > 0 else 0):
        out += codes[k : k + n].astype(np.uint64) * by[k]
    return out


def joined_bands(found: set[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """The bands in order, those of one document and item that overlap or touch as one."""
    held: list[int] = []
    for d, k, first, last in sorted(found):
        if held and held[:2] == [d, k] and first <= held[3] + 1:
            held[3] = max(held[3], last)
        else:
            if held:
                yield tuple(held)
            held = [d, k, first, last]
    if held:
        yield tuple(held)


@dataclass
class Table:
    """Where each gram of the items stands: sorted grams with item and place, and a bitmap that most other grams miss."""

    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    shift: np.uint64
    bits: np.ndarray

    @classmethod
    def build(cls, grams: list[np.ndarray], places: list[np.ndarray]) -> Table:
        join = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.empty(0, t)
        g, p = join(grams, np.uint64), join(places, np.int64)
        i = join([np.full(len(x), k) for k, x in enumerate(grams)], np.int64)
        order = np.argsort(g, kind="stable")
        width = max(16, int(len(g) * 32).bit_length())  # one place in 32 or less is taken
        bits = np.zeros(1 << width, bool)
        shift = np.uint64(64 - width)
        bits[((g * _HASH[1]) >> shift).astype(np.int64)] = True
        return cls(g[order], i[order], p[order], shift, bits)

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the gram, item and place of every match."""
        at = np.flatnonzero(self.bits[((grams * _HASH[1]) >> self.shift).astype(np.int64)])
        lo, hi = np.searchsorted(self.gram, grams[at], "left"), np.searchsorted(self.gram, grams[at], "right")
        many = hi - lo
        hit = np.repeat(lo, many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        return np.repeat(at, many), self.item[hit], self.place[hit]


@dataclass
class Items:
    """The query set: its characters, words, and indexes of its q-grams."""

    ids: list[int]
    codes: list[np.ndarray]
    word_starts: list[np.ndarray]
    plain: Table
    wide: Table
    need: np.ndarray
    span: np.ndarray
    offset: np.ndarray
    slack: np.ndarray
    shortest: np.ndarray
    short: bool

    @classmethod
    def build(cls, rows: list[tuple[int, str | None]]) -> Items:
        ids, codes, firsts, need, span, slack, least = [], [], [], [], [], [], []
        plain: tuple[list, list] = ([], [])
        wide: tuple[list, list] = ([], [])
        for item_id, text in rows:
            joined, starts, _ = letters(text or "")
            c = codes_of(joined)
            at = np.append(np.flatnonzero(starts), len(c))
            if item_id is None or len(at) <= WORDS:
                continue  # fewer than ten words: nothing of it can leak
            ids.append(int(item_id))
            codes.append(c)
            firsts.append(at)
            places = np.arange(max(len(c) - Q + 1, 0), dtype=np.int64)
            ascii_ = np.convolve(c > 127, np.ones(Q), "valid") == 0 if len(c) >= Q else np.zeros(0, bool)
            plain[0].append(grams_of(np.where(c > 127, 0, c), _BYTES)[ascii_])
            plain[1].append(places[ascii_])
            wide[0].append(grams_of(c, _HASH))
            wide[1].append(places)
            long = at[WORDS:] - at[:-WORDS]  # letters of ten words from each word on
            blocks = np.maximum((long + 1 - Q) // Q, 0)
            edits = np.minimum((EDIT_RATE * long).astype(np.int64), np.maximum(blocks - 2, 0))  # one block alone would call too many passages
            # from a place on: the fewest blocks, and the widest stretch, of ten words whose first unspoiled block may stand there
            n, s = np.full(len(c), 1 << 30, np.int64), np.zeros(len(c), np.int64)
            for begin, l, count, e in zip(at.tolist(), long.tolist(), (blocks - edits).tolist(), edits.tolist()):
                part = slice(begin, begin + Q * (e + 2))
                n[part] = np.minimum(n[part], max(count, 1))
                s[part] = np.maximum(s[part], l + e)
            least.append(int(long.min()))
            need.append(n)
            span.append(s)
            slack.append(max(1, int(edits.max())))
        # ten words that hold no whole block for certain: then grams are taken at every place, of which they hold three at least
        return cls(ids, codes, firsts, Table.build(*plain), Table.build(*wide), np.concatenate([*need, np.empty(0, np.int64)]), np.concatenate([*span, np.empty(0, np.int64)]), np.cumsum([0, *map(len, need)])[:-1], np.array(slack, np.int64), np.array(least, np.int64), any(x < 2 * Q - 1 for x in least))

    def bands(self, doc: np.ndarray, place: np.ndarray, item: np.ndarray, at: np.ndarray) -> set[tuple[int, int, int, int]]:
        """doc, item, first and last diagonal of each band that meets the bound, off hits (doc, its place, item, place in it)."""
        found: set[tuple[int, int, int, int]] = set()
        if not len(at):
            return found
        width = self.slack[item]
        where = self.offset[item] + at
        need, span = self.need[where], self.span[where]
        # bands of twice the slack and one, each overlapping the next by half, so that any passage lies in one whole
        for shift in (0, 1):
            band = (place - at + shift * width) // (2 * width)
            order = np.lexsort((place, band, item, doc))
            d, k, b, p, n = doc[order], item[order], band[order], place[order], need[order]
            # the passage's last block needed is at most its length further on
            other = np.arange(len(order)) + n - 1
            there = other < len(order)
            other = np.where(there, other, 0)
            good = there & (d[other] == d) & (k[other] == k) & (b[other] == b) & (p[other] - p <= span[order])
            for row in set(zip(d[good].tolist(), k[good].tolist(), b[good].tolist())):
                w = int(self.slack[row[1]])
                found.add((row[0], row[1], row[2] * 2 * w - shift * w, row[2] * 2 * w - shift * w + 2 * w - 1))
        return found

    def search(self, texts: list[str]) -> list[dict[int, tuple[int, int, int]]]:
        """For each text item_id: words in a row without an edit, words aligned, and edits among them, of each item with ten aligned words."""
        out: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        if not self.ids:
            return out
        small = [reduced(t) for t in texts]
        step = 1 if self.short else Q
        found: set[tuple[int, int, int, int]] = set()
        # documents side by side, each from a whole block on; what fills the gaps is no letter
        sized = [len(b) // Q * Q + Q if b is not None else 0 for b in small]
        begin = np.concatenate([[0], np.cumsum(sized)]).astype(np.int64)
        joined = b"".join(b.ljust(n, b"\0") for b, n in zip(small, sized) if b is not None)
        if joined:
            if step == Q:
                at, item, place = self.plain.hits(np.frombuffer(joined, "<u8"))
                at = at * Q
            else:
                at, item, place = self.plain.hits(grams_of(np.frombuffer(joined, np.uint8), _BYTES))
            doc = np.searchsorted(begin, at, "right") - 1
            found |= self.bands(doc, at - begin[doc], item, place)
        for d, b in enumerate(small):
            if b is None:
                g = grams_of(codes_of(letters(texts[d])[0]), _HASH)[::step]
                at, item, place = self.wide.hits(g)
                found |= self.bands(np.full(len(at), d, np.int64), at * step, item, place)
        last, held = -1, None
        for d, k, first, end in joined_bands(found):
            if d != last:
                joined_, starts, ends = letters(texts[d])
                last, held = d, (codes_of(joined_), starts, ends)
            words, aligned, edits = self.verify(k, first, end, *held)
            if aligned >= WORDS:
                was = out[d].get(self.ids[k], (0, 0, 0))
                out[d][self.ids[k]] = max(was, (words, aligned, -edits))
        return [{i: (w, a, -e) for i, (w, a, e) in rows.items()} for rows in out]

    def verify(self, k: int, first: int, last: int, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int]:
        """Words in a row without an edit, words in the aligned passage, and its edits, of item k in the diagonals from first to last.

        Only whole words count: at a passage's two ends the document must have a word boundary too, else that word is not counted.
        """
        c, at = self.codes[k], self.word_starts[k]
        unequal: dict[int, list[int]] = {}  # by diagonal, where item and document differ, closed by the ends
        longest = (0, 0, 0)  # length, start in the item, diagonal
        exact = 0
        for d in range(first, last + 1):
            i0, i1 = max(0, -d), min(len(c), len(codes) - d)
            if i1 <= i0:
                continue
            off = np.empty((differ := (c[i0:i1] != codes[i0 + d : i1 + d]).nonzero()[0]).size + 2, np.int64)
            off[0], off[1:-1], off[-1] = i0 - 1, differ + i0, i1
            unequal[d] = off.tolist()
            runs = off[1:] - off[:-1] - 1
            r = int(runs.argmax())
            longest = max(longest, (int(runs[r]), int(off[r]) + 1, d))
            if runs[r] >= self.shortest[k]:
                for r in (runs >= self.shortest[k]).nonzero()[0]:
                    exact = max(exact, self._whole(at, int(off[r]) + 1, int(off[r + 1]), d, d, starts, ends))
        if longest[0] < min(Q, int(self.shortest[k])):
            return exact, exact, 0
        n, a, d = longest
        stop, end_d, right = self._reach(unequal, a + n, d, 1, n)
        begin, begin_d, left = self._reach(unequal, a - 1, d, -1, n + stop - (a + n))
        aligned = self._whole(at, begin + 1, stop, begin_d, end_d, starts, ends)
        return exact, max(aligned, exact), (left + right if aligned >= exact else 0)

    @staticmethod
    def _reach(unequal: dict[int, list[int]], i: int, d: int, way: int, held: int) -> tuple[int, int, int]:
        """How far an alignment goes on from place i of the item on diagonal d (way 1 to its end, -1 to its start): place, diagonal, edits.

        held characters are aligned already. By edits, the furthest place on each diagonal of the band; the furthest of all that ends
        on equal characters and whose edits stay within EDIT_RATE of its length is taken.
        """

        def slide(at: int, on: int) -> int:
            off = unequal[on]
            if way > 0:
                return off[min(bisect_left(off, at), len(off) - 1)]
            return off[max(bisect_right(off, at) - 1, 0)]

        def inside(at: int, on: int) -> bool:
            return unequal[on][0] <= at <= unequal[on][-1]

        best, edits = (i, d, 0), 0
        front = {d: i}
        while front:
            edits += 1
            new: dict[int, int] = {}
            for on in unequal:
                # an edit that replaces keeps the diagonal; one that inserts or drops moves to the one beside it
                from_ = [front[on] + way] if on in front else []
                if on - way in front:
                    from_.append(front[on - way])
                if on + way in front:
                    from_.append(front[on + way] + way)
                from_ = [x for x in from_ if inside(x, on)]
                if from_:
                    start = max(from_) if way > 0 else min(from_)
                    new[on] = slide(start, on)
                    gone = abs(new[on] - i)
                    if new[on] != start and edits <= EDIT_RATE * (held + gone) and gone > abs(best[0] - i):
                        best = (new[on], on, edits)
            front = new
            if not new or edits > EDIT_RATE * (held + max(abs(x - i) for x in new.values())) + 1:
                break
        return best

    @staticmethod
    def _whole(at: np.ndarray, a: int, b: int, on_a: int, on_b: int, starts: np.ndarray, ends: np.ndarray) -> int:
        """Words of the item that lie whole in [a, b), with word boundaries of the document at both ends."""
        w0, w1 = int(np.searchsorted(at, a, "left")), int(np.searchsorted(at, b, "right")) - 1
        if w1 > w0 and not starts[at[w0] + on_a]:
            w0 += 1
        if w1 > w0 and not ends[at[w1] - 1 + on_b]:
            w1 -= 1
        return max(w1 - w0, 0)


_BUILT: dict[object, Items] = {}


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, words, aligned_words, edits: documents that hold a passage of at least ten words of an item's text.

    Case, accents, punctuation, spacing, markup and invisible characters are ignored. words is the longest run of words without
    an edit, which may be less than ten; aligned_words is the passage with edits, of which there are at most EDIT_RATE of
    its characters. Null or empty texts, on either side, and items of fewer than ten words leak nothing; a
    repeated doc_id gives one row an item. The items are read in blocks of at most BLOCK_CHARS characters, each searched
    in all documents, so that no index outgrows an executor.
    """
    spark = documents.sparkSession
    blocks: list[list[tuple[int, str]]] = [[]]
    held = 0
    for row in items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        if held + len(row.text) > BLOCK_CHARS and blocks[-1]:
            blocks.append([])
            held = 0
        blocks[-1].append((row.item_id, row.text))
        held += len(row.text)
    texts = documents.select("doc_id", "text").where("doc_id IS NOT NULL AND length(text) > 0")
    found = None
    for block in blocks:
        sent = spark.sparkContext.broadcast(block)
        name = uuid.uuid4().hex

        def search(batches: Iterator[pd.DataFrame], sent=sent, name=name) -> Iterator[pd.DataFrame]:
            if name not in _BUILT:  # once a worker, whatever the number of its tasks
                _BUILT.clear()
                _BUILT[name] = Items.build(sent.value)
            index = _BUILT[name]
            for batch in batches:
                ids, column = batch["doc_id"].tolist(), batch["text"].tolist()
                rows = []
                for k in range(0, len(ids), TOGETHER):
                    for d, leaked in zip(ids[k : k + TOGETHER], index.search(column[k : k + TOGETHER])):
                        rows += [(d, i, w, a, e) for i, (w, a, e) in leaked.items()]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "words", "aligned_words", "edits"]).astype("int64")

        part = texts.mapInPandas(search, "doc_id BIGINT, item_id BIGINT, words BIGINT, aligned_words BIGINT, edits BIGINT")
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("words", "aligned_words", (-F.col("edits")).alias("e"))).alias("m")).select("doc_id", "item_id", "m.words", "m.aligned_words", (-F.col("m.e")).alias("edits"))


def exact(leaked: DataFrame) -> DataFrame:
    """doc_id, item_id of the leaks with ten words in a row without an edit."""
    return leaked.where(F.col("words") >= WORDS).select("doc_id", "item_id")
