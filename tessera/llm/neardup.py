"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``BANDS`` short keys, each of ``ROWS`` minhashes, are made for every different shingle
set. A table key is a pair, one key from each collection, so BANDS * BANDS tables of 2 * ROWS minhashes
cost only 2 * BANDS * ROWS minhashes. A set whose key of the first collection nobody shares can't
collide in any of its tables, so pairs are formed only for the rest. Two sets with a Jaccard similarity of 0.85
miss each other with a probability of 2e-5, of 0.8 with 4e-4.

Candidates are confirmed on full shingle sets. Equal sets are one class from the start, so copies are not
paired. Inside a table key, sets are first compared with the least one there; where those that are left
are in different components, all of them are compared by their signatures. A key with many sets goes through more rounds
before: those outside its largest component are compared with another member of it each time, which joins the near copies of a
large group. What is still in many components, as pages of one template are, is split by longer keys, whose length
follows the number of sets, so that few of them meet by their template alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.shared import settle, small_batches
from tessera.llm.textops import BASE, IS_SPACE, LOWER, chunks, hash_runs, mix, runs, shingle_hashes

ROWS, BANDS, WIDTH, PERCENT = 3, 12, 5, 85
#: Pairs whose signatures agree less than this many percent below the threshold are not confirmed: over four standard errors.
SLACK = 19
#: Sets of one table key that are compared in one block; a key that is not split has one, so its sets are not copied.
BLOCK = 2048
HASHES = 2 * ROWS * BANDS
#: Minhashes of a long signature, of which one byte is kept, and by how many standard errors below the threshold they may agree.
LONG, LONG_SLACK = 768, 4.65
#: Sets of a key from which it goes through rounds with other hubs and is split, and how many such rounds there are.
CROWD, ROUNDS = 2048, 4
#: Probability that a similar pair of a split key meets in none of its longer keys, and least and most minhashes of one.
MISS, SHORTEST, LONGEST = 1e-4, 8, 20


def need(percent: float) -> float:
    """How many of HASHES minhashes must agree."""
    return HASHES * (percent - SLACK) / 100


def long_need(percent: float) -> float:
    """How many of LONG minhashes must agree: 0.79 of them for 85 %, 0.73 for 80 %."""
    p = percent / 100
    return LONG * p - LONG_SLACK * (LONG * p * (1 - p)) ** 0.5


_rng = np.random.Generator(np.random.PCG64(7))
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for _, _, data, off in chunks(column):
        data = LOWER[data]
        starts, ends, row_words = runs(~IS_SPACE[data], off)
        hashes, row = shingle_hashes(hash_runs(data, starts, ends), row_words, width)
        for k in range(len(row) - 1):
            yield np.unique(hashes[row[k] : row[k + 1]])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minhashes (rows, HASHES) of sets that are not empty."""
    out = np.empty((len(sets), HASHES), np.uint64)
    a, cut = 0, 1 << 16
    while a < len(sets):
        b, total = a, 0
        while b < len(sets) and (b == a or total + len(sets[b]) <= cut):
            total += len(sets[b])
            b += 1
        flat = np.concatenate(sets[a:b])
        first = np.cumsum([0] + [len(s) for s in sets[a : b - 1]])
        for k in range(HASHES):
            out[a:b, k] = np.minimum.reduceat(flat * _A[k] + _B[k], first)
        a = b
    return out


def _bands(sig: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sig), 2 * BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix(keys + sig[:, k::ROWS] + np.uint64(k))
    return keys


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column(1)))
        filled = [k for k, s in enumerate(sets) if len(s)]
        empty = [None] * len(sets)
        digest, u, v, short = empty[:], empty[:], empty[:], empty[:]
        if filled:
            sig = signatures([sets[k] for k in filled])
            keys = _bands(sig).view(np.int64)
            tops = (sig >> np.uint64(48)).astype(np.uint16)
            for row, k in enumerate(filled):
                digest[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                u[k], v[k], short[k] = keys[row, :BANDS], keys[row, BANDS:], tops[row].tobytes()
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(u, lists), pa.array(v, lists), pa.array(short, pa.binary())],
            ["doc_id", "n_shingles", "digest", "u", "v", "sig"],
        )


def _alike(batches: Iterator[pa.RecordBatch], percent: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, sig of a, sig of b) whose signatures agree enough."""
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, HASHES) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).sum(1) >= need(percent)))


def _confirm(batches: Iterator[pa.RecordBatch], percent: float) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text of a, text of b) whose full sets are similar enough."""
    last, q = None, np.zeros(0, np.uint64)
    for batch in batches:
        keep = []
        hubs = batch.column(1).to_pylist()
        for k, p in enumerate(shingle_sets(batch.column(2))):
            if hubs[k] != last:
                last, q = hubs[k], next(shingle_sets(batch.column(3).slice(k, 1)))
            small, large = (p, q) if len(p) <= len(q) else (q, p)
            if 100 * len(small) < percent * len(large) or not len(small):
                continue
            at = np.searchsorted(large, small)
            at[at == len(large)] = 0
            common = int((large[at] == small).sum())
            if 100 * common >= percent * (len(p) + len(q) - common):
                keep.append(k)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


#: Bits of the filter below, as powers of 2: at most 2**27, in 2**21 rows of 64.
_FILTER_BITS = 16, 27


def _texts_of(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``_texts_with`` the ids of pairs that are written down."""
    ids = pairs.select(F.col("a").alias("id")).distinct().union(pairs.select("b").distinct())
    return _texts_with(texts, ids, 2 * pairs.count())


def _texts_with(texts: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """The rows (id, text) with one of the ids, and few others.

    Ids, ``most`` at most, set bits of a filter that has 16 for each of them, up to a size that can be broadcast whatever the
    input, so that texts in no pair are not shuffled; where it fills up it only keeps more.
    """
    bits = min(_FILTER_BITS[1], max(_FILTER_BITS[0], (16 * most).bit_length()))
    bit = F.xxhash64("id").bitwiseAND(F.lit(2**bits - 1))
    word = F.shiftright(bit, 6)
    mask = F.expr(f"shiftleft(1L, CAST((xxhash64(id) & {2**bits - 1}) & 63 AS INT))")
    filled = ids.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))
    return texts.withColumn("word", word).join(F.broadcast(filled), "word").filter(F.col("bits").bitwiseAND(mask) != 0).select("id", "text")


def _near(pairs: DataFrame, sets: DataFrame, percent: float) -> DataFrame:
    """Those of the pairs (a, b) whose signatures agree enough."""
    sig = sets.select("id", "sig")
    with_sig = pairs.join(sig.toDF("a", "x"), "a").join(sig.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return with_sig.mapInArrow(partial(_alike, percent=percent), "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: float) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    pairs = settle(pairs)
    some = _texts_of(texts, pairs)
    both = pairs.join(some.toDF("a", "x"), "a").join(some.toDF("b", "y"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(partial(_confirm, percent=percent), "a long, b long").distinct()


def _long_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, long): one byte of each of LONG minhashes."""
    rng = np.random.Generator(np.random.PCG64(8))
    a, b = rng.integers(1, 2**63, LONG, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**63, LONG, dtype=np.uint64)
    for batch in batches:
        ids, out = [], []
        for k, s in enumerate(shingle_sets(batch.column(1))):
            if len(s):
                least = np.full(LONG, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 1024):
                    np.minimum(least, (s[at : at + 1024, None] * a + b).min(0), out=least)
                ids.append(k)
                out.append((mix(least) >> np.uint64(56)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(out, pa.binary())], ["id", "long"])


def split_keys(n: int, percent: float) -> tuple[int, int]:
    """How many minhashes the longer keys have where up to n sets share a key, and how many such keys a set has.

    So long that of n sets of similarity 0.5 about one has the same, so many that similar pairs meet.
    """
    length = min(LONGEST, max(SHORTEST, int(n).bit_length()))
    return length, int(np.ceil(np.log(MISS) / np.log1p(-((percent / 100) ** length))))


def _split(batches: Iterator[pa.RecordBatch], length: int, keys: int) -> Iterator[pa.RecordBatch]:
    """(id, component, long) to (key, id, component): the longer keys of each set, from chosen places of its long signature."""
    rng = np.random.Generator(np.random.PCG64(length))
    places = np.stack([rng.permutation(LONG)[:length] for _ in range(keys)])
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            some = batch.slice(a, 1024)
            long = np.frombuffer(b"".join(some.column(2).to_pylist()), np.uint8).reshape(-1, LONG).astype(np.uint64)
            h = np.broadcast_to(np.arange(keys, dtype=np.uint64), (len(long), keys))
            for k in range(length):
                h = mix(h * BASE + long[:, places[:, k]])
            ids, component = (np.repeat(some.column(k).to_numpy(), keys) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(ids), pa.array(component)], ["key", "id", "component"])


def _pairs_in_groups(rows: pa.Table, percent: float) -> pa.RecordBatch:
    """Pairs (a, b) of different components in a group of rows, sorted by group, whose long signatures agree enough.

    A pair that meets in several tables is given in the first of them only; a place of -1 is no table.
    """
    group, ids, component, block, single, place = (rows.column(k).to_numpy() for k in (0, 1, 2, 3, 4, 6))
    u, v = (rows.column(k).combine_chunks().flatten().to_numpy().reshape(-1, BANDS) for k in (7, 8))
    long = np.frombuffer(b"".join(rows.column(5).to_pylist()), np.uint8).reshape(-1, LONG)
    found, first = [], np.arange(len(group))
    for d in range(1, len(group)):
        first = first[first + d < len(group)]
        first = first[group[first] == group[first + d]]
        if not len(first):
            break
        other = first + d
        p = (component[first] != component[other]) & (single[first] | (block[first] != block[other]))
        x, y = first[p], other[p]
        near = (long[x] == long[y]).sum(1) >= long_need(percent)
        x, y = x[near], y[near]
        here = (place[x] < 0) | ((u[x] == u[y]).argmax(1) * BANDS + (v[x] == v[y]).argmax(1) == place[x])
        found.append(np.stack([np.maximum(ids[x], ids[y])[here], np.minimum(ids[x], ids[y])[here]]))
    pairs = np.unique(np.concatenate(found, 1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _compare(batches: Iterator[pa.RecordBatch], percent: float) -> Iterator[pa.RecordBatch]:
    """``_pairs_in_groups`` over batches; a group that runs over the end of one waits for the next."""
    waiting: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0).to_numpy()
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield _pairs_in_groups(pa.Table.from_batches([*waiting, batch.slice(0, cut)]), percent)
            waiting = []
        elif waiting and waiting[0].column(0)[0].as_py() != group[0]:
            yield _pairs_in_groups(pa.Table.from_batches(waiting), percent)
            waiting = []
        waiting.append(batch.slice(cut))
    if waiting:
        yield _pairs_in_groups(pa.Table.from_batches(waiting), percent)


def _table_keys(sets: DataFrame) -> DataFrame:
    """(id, key, place) of the tables in which a set may meet another; place is the number of the table."""
    first = sets.select("id", F.posexplode("u").alias("i", "uk"))
    shared = first.groupBy("i", "uk").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("i", "uk")
    alive = first.join(shared, ["i", "uk"])
    both = alive.join(sets.select("id", "v"), "id").select("id", "i", "uk", F.posexplode("v").alias("j", "vk"))
    return both.select("id", F.xxhash64("i", "uk", "j", "vk").alias("key"), (F.col("i") * BANDS + F.col("j")).alias("place"))


def _several(named: DataFrame) -> DataFrame:
    """(key, n) of the keys whose n rows are of several components."""
    return named.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d"), F.count("*").alias("n")).filter("c < d").select("key", "n")


def _grouped(rest: DataFrame) -> DataFrame:
    """The rows of keys with n sets each by groups in which all are compared: a key, or each two of its blocks if it has more than ``BLOCK``."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rest.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    group = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    # All pairs inside a block are compared in its own group only.
    return rows.select(group.alias("group"), "id", "component", "block", (F.col("block") == F.col("other")).alias("single"), "long", "place", "u", "v")


def _hub_round(rest: DataFrame, sets: DataFrame, texts: DataFrame, percent: float, number: int) -> DataFrame:
    """Confirmed links (a, b) between sets outside the largest component of a crowded key and one member b of that."""
    sizes = rest.filter(F.col("n") > CROWD).groupBy("key", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("size", "component")).alias("x")).select("key", F.col("x.component").alias("main"))
    rows = rest.join(largest, "key")
    hub = rows.filter("component = main").groupBy("key").agg(F.min_by("id", F.xxhash64("id", F.lit(number))).alias("b"))
    pairs = rows.filter("component <> main").join(hub, "key").select(F.col("id").alias("a"), "b").distinct()
    return settle(_confirmed(_near(pairs, sets, percent), texts, percent))


def _joined(rest: DataFrame, links: DataFrame) -> DataFrame:
    """``rest`` after each component with a link (a, b) from it has taken the name of one that it leads to; what is closed then goes.

    Sets of one name are connected; connected ones may still have two.
    """
    names = rest.select("id", "component").distinct()
    to = links.join(names.toDF("a", "from"), "a").join(names.toDF("b", "to"), "b").groupBy("from").agg(F.min("to").alias("to"))
    now = rest.join(to, F.col("component") == F.col("from"), "left").select("id", "key", "place", F.coalesce("to", "component").alias("component"))
    return settle(now.join(_several(now).filter("n > 2"), "key"))


def _links(sets: DataFrame, texts: DataFrame, percent: float) -> DataFrame:
    """Confirmed links (a, b) that connect what is similar."""
    keys = settle(_table_keys(sets))
    hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).filter("hub < top").select("key", "hub")
    to_hub = keys.join(hubs, "key").filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    links = settle(_confirmed(_near(to_hub, sets, percent), texts, percent))

    # Keys that still hold several components: all pairs of those but for the pairs with the hub, which are done.
    known = components(links)
    named = keys.join(known, keys["id"] == known["node"], "left").select("id", "key", "place", F.coalesce("component", "id").alias("component"))
    rest = settle(named.join(_several(named).filter("n > 2"), "key"))
    crowd = rest.agg(F.max("n")).first()[0] or 0
    for number in range(ROUNDS):
        if crowd <= CROWD:
            break
        more = _hub_round(rest, sets, texts, percent, number)
        if more.isEmpty():
            break
        links, rest = links.union(more), _joined(rest, more)
        crowd = rest.agg(F.max("n")).first()[0] or 0
    long = settle(_texts_with(texts, rest.select("id"), rest.count()).mapInArrow(_long_signatures, "id long, long binary"))
    if crowd > CROWD:
        # Each pair that meets in a crowded key is of two crowded sets, so one lot of longer keys does for all those keys.
        length, keys_each = split_keys(crowd, percent)
        crowded = rest.filter(F.col("n") > CROWD).select("id", "component").distinct().join(long, "id").select("id", "component", "long")
        split = settle(crowded.mapInArrow(partial(_split, length=length, keys=keys_each), "key long, id long, component long"))
        split = split.join(_several(split), "key").withColumn("place", F.lit(-1))
        rest = rest.filter(F.col("n") <= CROWD).unionByName(split.select(*rest.columns))
    late = _grouped(rest.join(long, "id").join(sets.select("id", "u", "v"), "id"))
    late = late.repartition("group").sortWithinPartitions("group").mapInArrow(partial(_compare, percent=percent), "a long, b long").distinct()
    return links.union(_confirmed(late, texts, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: float = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs``.

    Words are runs without white space, A-Z in lower case; a document's set holds its different
    shingles of five words, or all its words as one if fewer. Sets that share ``percent`` % of their union are linked.
    ``component_id`` is the least doc_id reachable; ``kept`` says whether it is the row's own. A document without
    words (or null) has no shingles and is linked with nothing. Rows of one doc_id are documents of
    their own with that id, so each is kept if the id is; a row with null id has a null component, is kept, and links nothing.
    """
    small_batches(docs)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    described = settle(source.mapInArrow(_describe, "doc_id long, n_shingles long, digest binary, u array<long>, v array<long>, sig binary"))
    filled = described.filter("digest is not null and doc_id is not null")
    # Rows of one digest have equal sets, so equal keys and signatures.
    sets = settle(filled.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("u").alias("u"), F.first("v").alias("v"), F.first("sig").alias("sig")))
    classes = sets.select("digest", "id")
    texts = source.select(F.col("doc_id").alias("id"), "text")
    # A doc_id that several rows have with other texts is one node: its texts are linked through it.
    several = filled.groupBy("doc_id").agg(F.min("digest").alias("p"), F.max("digest").alias("q")).filter("p <> q").select("doc_id")
    through = filled.join(several, "doc_id").join(classes, "digest").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    linked = components(_links(sets, texts, percent).union(through))
    best = classes.join(linked, classes["id"] == linked["node"], "left").select("digest", F.coalesce("component", "id").alias("component_id"))
    out = described.join(best, "digest", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def without_near_duplicates(docs: DataFrame, percent: float = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of linked rows, and every row with a null id.

    Each row is a document of its own, so rows of one id with texts that are not linked all stay. Of a group, the
    row with the least id stays; of several with that id, that with the least hash of its columns.
    """
    rows = settle(docs.withColumn("__row", F.monotonically_increasing_id()))
    own = rows.filter(F.col(id_col).isNotNull())
    found = near_duplicates(own, "__row", text_col, percent).select(F.col("doc_id").alias("__found"), "component_id")
    order = own.select("__row", F.struct(F.col(id_col), F.xxhash64(*docs.columns), F.col("__row")).alias("order"))
    least = found.join(order, F.expr("__found = __row")).groupBy("component_id").agg(F.min("order").alias("least")).select(F.col("least.__row").alias("__stays"))
    return rows.join(least, F.expr("__row = __stays"), "left").filter(F.col(id_col).isNull() | F.col("__stays").isNotNull()).select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a),
least AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""
