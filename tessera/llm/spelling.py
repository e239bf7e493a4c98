"""Spelling variants by a trie over letter-group counts.

A word's vector says how many of its letters are in each of a few groups of letters. The vectors of all words make a trie, with a level
for each group. One edit adds at most one letter to one group and takes at most one from another, so a depth-first search from the root
that may spend one surplus and one deficit meets all words that are one edit away; the words at the leaves are compared letter by
letter.

The trie is cut at a depth where no subtree holds many words. A subtree is one group of rows: its own words, and the words that can
come to its top within their budget. The search inside it goes down with all of these at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import settle, small_batches
from tessera.llm.textops import LOWER, runs, utf8

#: Letter groups, the levels of the trie.
GROUPS = 12
#: Words of a subtree that are one task's. A subtree of more words that has no deeper level is dealt by a hash, and searched in each part.
SUBTREE = 4000
#: A subtree of the trie with so few words is a leaf.
LEAF = 12
#: Pairs that are compared at a time, and the longest words that are compared as rows of a matrix; longer ones go one by one.
PAIRS, LONG = 1 << 18, 64

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: One occurrence in so many loses a letter.
EDIT = 199

_MEMBER = np.zeros(256, bool)
_MEMBER[[*range(65, 91), *range(97, 123), 0xC3]] = True


def _crc_table() -> np.ndarray:
    """The table of CRC-32 for one byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc_after(start: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of texts with the checksums ``start`` that go on with runs of ``data``."""
    size = ends - starts
    out = start.copy()
    for k in np.flatnonzero(size > LONG):
        out[k] = zlib.crc32(data[starts[k] : ends[k]], int(start[k]))
    at = np.flatnonzero(size <= LONG)
    state = ~start[at]
    for k in range(int(size[at].max(initial=0))):
        some = np.flatnonzero(size[at] > k)
        now = state[some]
        state[some] = _CRC[(now ^ data[starts[at[some]] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    out[at] = ~state
    return out


def _count_batch(ids: list[str | None], column: pa.Array, least: int) -> tuple[pa.Array, pa.Array]:
    """Different words of a batch of texts, after the edits, and how often each occurs."""
    data, off = utf8(column)
    data = LOWER[data]
    member = _MEMBER[data]
    member[1:] |= data[:-1] == 0xC3
    starts, ends, row_runs = runs(member, off)
    lead = np.concatenate([[0], np.cumsum(data == 0xC3)])
    points = (ends - starts) - (lead[ends] - lead[starts])
    row = np.repeat(np.arange(len(off) - 1), np.diff(row_runs))
    keep = points >= least
    starts, ends, row = starts[keep], ends[keep], row[keep]
    prefix = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in ids], np.uint32)
    h = crc_after(prefix[row], data, starts, ends)
    hit = h % np.uint32(EDIT) == 0
    edited = []
    for s, e, c in zip(starts[hit].tolist(), ends[hit].tolist(), h[hit].tolist(), strict=True):
        word = data[s:e].tobytes().decode()
        cut = c % len(word)
        if len(word) > least:
            edited.append(word[:cut] + word[cut + 1 :])
    starts, ends = starts[~hit], ends[~hit]
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    body = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body)))
    both = pa.chunked_array([words, pa.array(edited, pa.large_string())])
    found = pc.value_counts(both)
    return found.field("values").cast(pa.string()), found.field("counts")


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts with at least so many letters and occurrences, after the edits of single occurrences."""
    small_batches(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = _count_batch(batch.column(0).to_pylist(), batch.column(1), least_length)
            yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letter_groups(words: DataFrame) -> dict[str, int]:
    """The group of each letter: letters by falling number of occurrences are dealt to the groups in turn, back and forth.

    There are no more letters than the word pattern allows, so they may be collected.
    """
    counted = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").count().orderBy(F.desc("count"), "c").collect()
    turn = [*range(GROUPS), *reversed(range(GROUPS))]
    return {r["c"]: turn[k % len(turn)] for k, r in enumerate(counted)}


def vector(word: Column, groups: dict[str, int]) -> Column:
    """How many letters of a word are in each group."""
    classes = ["".join(c for c, g in groups.items() if g == k) for k in range(GROUPS)]
    size = F.char_length(word)
    return F.array(*[size - F.char_length(F.translate(word, c, "")) if c else F.lit(0) for c in classes])


def _depth(words: DataFrame) -> int:
    """The least depth of the trie at which no subtree has over SUBTREE words, or all levels."""
    depth = 0
    while depth < GROUPS:
        most = words.groupBy(F.slice("v", 1, depth)).count().agg(F.max("count")).first()[0]
        if (most or 0) <= SUBTREE:
            break
        depth += 1
    return depth


def _budgets(depth: int) -> list[tuple[list[int], int, int]]:
    """Ways to spend the budget above ``depth``: the changes of the first counts, and the surplus and deficit that are left."""
    out = [([0] * depth, 1, 1)]
    unit = lambda *at: [sum(s for k, s in at if k == g) for g in range(depth)]
    out += [(unit((k, 1)), 0, 1) for k in range(depth)] + [(unit((k, -1)), 1, 0) for k in range(depth)]
    return out + [(unit((a, 1), (b, -1)), 0, 0) for a in range(depth) for b in range(depth) if a != b]


def one_edit(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> np.ndarray:
    """Whether words differ by exactly one letter added, taken or replaced. ``a``, ``b``: letters from the left, 0 after the end; ``wa``, ``wb``: from the right."""
    differs, backwards = a != b, wa != wb
    width = a.shape[1]
    front = np.where(differs.any(1), differs.argmax(1), width)
    back = np.where(backwards.any(1), backwards.argmax(1), width)
    longer, shorter = np.maximum(size_a, size_b), np.minimum(size_a, size_b)
    return (front < longer) & (longer - shorter <= 1) & (front + back >= longer - 1)


def _plain_one_edit(a: str, b: str) -> bool:
    """The same for two words."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


class Subtree:
    """The words of a subtree and those that look for them, as arrays."""

    def __init__(self, words: list[str], counts: list[int], vectors: np.ndarray, askers: list[str], asking: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, depth: int) -> None:
        order = np.lexsort(vectors.T[::-1]) if len(words) else np.zeros(0, int)
        self.words, self.v = [words[k] for k in order], vectors[order]
        self.counts = np.array(counts, np.int64)[order]
        by_name = np.array(sorted(range(len(self.words)), key=self.words.__getitem__), int)
        self.rank = np.empty(len(self.words), np.int64)
        self.rank[by_name] = np.arange(len(by_name))  # strings sort by code points
        self.askers, self.q, self.surplus, self.deficit, self.depth = askers, asking, surplus, deficit, depth
        self.left, self.right, self.size = self._letters(self.words)
        self.q_left, self.q_right, self.q_size = self._letters(askers)
        self.near = np.zeros(len(askers), np.int64)
        self.best = np.full(len(askers), -1, np.int64)  # of the words found, that of most occurrences, then the least
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    @staticmethod
    def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters from the left and from the right, and lengths; words longer than LONG are rows of zeros."""
        size = np.array([len(w) for w in words], np.int64)
        short = [w if len(w) <= LONG else "" for w in words]
        width = max([1, *map(len, short)])
        rows = lambda each: np.array(each, f"U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint16) if words else np.zeros((0, width), np.uint16)
        return rows(short), rows([w[::-1] for w in short]), size

    def search(self) -> None:
        """Down the trie, depth first; each node once, with all words that can come there."""
        stack = [(0, len(self.words), self.depth, np.arange(len(self.askers)), self.surplus, self.deficit)]
        while stack:
            lo, hi, level, q, surplus, deficit = stack.pop()
            if hi - lo <= LEAF or level == GROUPS:
                self._leaf(lo, hi, level, q, surplus, deficit)
                continue
            column = self.v[lo:hi, level]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [hi - lo]])
            own = self.q[q, level]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                change = int(column[a]) - own
                some = np.flatnonzero((change == 0) | ((change == 1) & (surplus > 0)) | ((change == -1) & (deficit > 0)))
                if len(some):
                    stack.append((lo + a, lo + b, level + 1, q[some], surplus[some] - (change[some] == 1), deficit[some] - (change[some] == -1)))
        self._compare()

    def _leaf(self, lo: int, hi: int, level: int, q: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
        """All words of a leaf whose remaining counts are inside the budget wait for comparison."""
        for start in range(0, len(q), max(1, PAIRS // (hi - lo))):
            part = slice(start, start + max(1, PAIRS // (hi - lo)))
            change = self.v[None, lo:hi, level:] - self.q[q[part], level:][:, None, :]
            within = (np.maximum(change, 0).sum(2) <= surplus[part][:, None]) & (np.maximum(-change, 0).sum(2) <= deficit[part][:, None])
            i, j = np.nonzero(within)
            self.waiting.append((q[part][i], j + lo))
            self.held += len(i)
            if self.held >= PAIRS:
                self._compare()

    def _compare(self) -> None:
        """Count the pairs that are one edit apart, and keep the best word of each asker."""
        if not self.waiting:
            return
        i, j = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        self.waiting, self.held = [], 0
        width = max(self.left.shape[1], self.q_left.shape[1])
        wide = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
        long = np.maximum(self.q_size[i], self.size[j]) > LONG
        fine = np.zeros(len(i), bool)
        for a in range(0, len(i), PAIRS):
            p, w = i[a : a + PAIRS], j[a : a + PAIRS]
            fine[a : a + PAIRS] = one_edit(wide(self.q_left[p]), wide(self.left[w]), self.q_size[p], self.size[w], wide(self.q_right[p]), wide(self.right[w]))
        for k in np.flatnonzero(long).tolist():
            fine[k] = _plain_one_edit(self.askers[i[k]], self.words[j[k]])
        i, j = i[fine], j[fine]
        np.add.at(self.near, i, 1)
        order = np.lexsort((self.rank[j], -self.counts[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        for k, w in zip(i[first].tolist(), j[first].tolist(), strict=True):
            old = self.best[k]
            if old < 0 or (-self.counts[w], self.rank[w]) < (-self.counts[old], self.rank[old]):
                self.best[k] = w


def _search_group(rows: pd.DataFrame) -> pd.DataFrame:
    """The near words of one subtree: (word, n_near, near, near_n) of each word that has some here."""
    own, asking = rows[rows["surplus"] < 0], rows[rows["surplus"] >= 0]
    empty = pd.DataFrame({"word": pd.Series(dtype=str), "n_near": pd.Series(dtype="int64"), "near": pd.Series(dtype=str), "near_n": pd.Series(dtype="int64")})
    if own.empty or asking.empty:
        return empty
    matrix = lambda of: np.array(of["v"].tolist(), np.int32).reshape(len(of), GROUPS)
    tree = Subtree(own["word"].tolist(), own["n"].tolist(), matrix(own), asking["word"].tolist(), matrix(asking), asking["surplus"].to_numpy(np.int64), asking["deficit"].to_numpy(np.int64), int(rows["depth"].iloc[0]))
    tree.search()
    hit = np.flatnonzero(tree.near)
    if not len(hit):
        return empty
    best = tree.best[hit].tolist()
    return pd.DataFrame({"word": [tree.askers[k] for k in hit], "n_near": tree.near[hit], "near": [tree.words[k] for k in best], "near_n": tree.counts[best]})


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) of the words (word, n) that have others one edit away: how many, and the one of most occurrences, of several the least.

    Each subtree is searched by all words that can come there; what they find there is one row, and these are added up.
    """
    groups = letter_groups(words)
    own = settle(words.select("word", "n", vector(F.col("word"), groups).alias("v")))
    depth = _depth(own)
    top = F.slice("v", 1, depth)
    cells = own.groupBy(top.alias("top")).agg(F.ceil(F.count("*") / SUBTREE).cast("int").alias("parts"))
    level = F.lit(depth)
    # Where a subtree is still too large, its words are dealt to parts, and those that look for them go to each part.
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    held = own.withColumn("top", top).join(cells, "top").select("top", part.alias("part"), level.alias("depth"), "word", "n", "v", F.lit(-1).alias("surplus"), F.lit(0).alias("deficit"))
    ways = F.array(*[F.struct(F.array(*map(F.lit, c)).cast("array<int>").alias("change"), F.lit(s).alias("surplus"), F.lit(d).alias("deficit")) for c, s, d in _budgets(depth)])
    spread = own.select("word", "n", "v", top.alias("own_top"), F.explode(ways).alias("way"))
    asked = spread.select("word", "n", "v", "way.surplus", "way.deficit", F.zip_with("own_top", "way.change", lambda a, b: a + b).alias("top"))
    asked = asked.filter(F.forall("top", lambda c: c >= 0)).join(cells, "top")
    asked = asked.select("top", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), level.alias("depth"), "word", "n", "v", "surplus", "deficit")
    found = held.unionByName(asked).groupBy("top", "part").applyInPandas(_search_group, "word string, n_near long, near string, near_n long")
    least = F.min(F.struct((-F.col("near_n")).alias("k"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), least.alias("m")).select("word", "n_near", F.col("m.near").alias("near"), (-F.col("m.k")).alias("near_n"))


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO) -> DataFrame:
    """Words of all texts and the words that they are variants of: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters with A to Z in lower case, of at least six letters and five occurrences; a hash of document id and
    word takes a letter from one occurrence in 199. ``form`` is the near word of most occurrences, of several the least, if it has
    ``ratio`` times as many; ``root`` the end of the chain of forms. Occurrences grow along a chain, so it ends. Null texts have no words,
    a null id counts as an empty one, repeated rows count each. No words give no rows. Other columns are not looked at.
    """
    words = settle(count_words(docs, id_col, text_col))
    near = near_words(words)
    has_form = F.col("near_n") >= ratio * F.col("n")
    rows = settle(words.join(near, "word", "left").select("word", F.when(has_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("near_n")).alias("form_n")))
    # Each step doubles the part of a chain that is known; a chain is no longer than a long has powers of the ratio.
    known = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        known = settle(known)
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = known.join(ahead, "root", "left")
        if step.filter("further is not null").isEmpty():
            break
        known = step.select("word", F.coalesce("further", "root").alias("root"))
    return rows.join(known, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: Checksums byte by byte, and near words by what is left of them without one letter.
ORACLE = """
WITH RECURSIVE bytes AS (SELECT b, list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(b)),
crc AS (SELECT list(v ORDER BY b) AS t FROM bytes),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS w FROM documents),
each AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY doc_id, w),
keys AS (SELECT w, n, encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w) AS k FROM each),
octets AS (SELECT w, n, list_transform(range(0, octet_length(k)), lambda i: CAST(('0x' || substr(hex(k), 2 * i + 1, 2)) AS BIGINT)) AS o FROM keys),
hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, o), lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) AS h FROM octets, crc),
occ AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM occ WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
pairs AS (SELECT DISTINCT a.word AS a, b.word AS b, b.n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.cut = b.word
UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.cut = b.word),
near AS (SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS best, max(n) AS best_n FROM pairs GROUP BY a),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form, CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM words LEFT JOIN near ON word = a),
up AS (SELECT word, word AS root, 0 AS d FROM forms UNION ALL SELECT up.word, forms.form, d + 1 FROM up JOIN forms ON up.root = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, d) AS root FROM up GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
