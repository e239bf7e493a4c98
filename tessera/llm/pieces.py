"""SentencePiece encoding with seeded merge-dropout, and decoding.

Merges of the model's vocabulary are processed from an agenda, best first. A candidate that comes up is
skipped where a keyed hash of the seed, the document, the occurrence and the candidate's turn says so, which gives
varied segmentations into the model's own pieces. A unit is a word with the spaces before it (no piece
crosses from a letter to a space). Each occurrence of a unit has drops of its own, a bit for each turn, and
results do not depend on how documents are dealt to tasks. Segmentations are kept by unit and the drops that
they met, which says them whole, so what is kept never stands for other drops. All occurrences of a chunk
look theirs up together.

Characters that no piece has, and U+2581 itself, become byte pieces, so decoding gives back every text.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from tessera.llm.shared import small_batches
from tessera.llm.textops import BASE, chunks, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 1
#: Segmentations that a worker keeps, and how many children of one.
KEPT, BRANCHES = 250_000, 24
#: Longest unit whose drops fit in 63 bits: n characters have 3 * (n - 1) candidates at most.
SHORT = 22
SPACE = "▁"
_UNITS = re.compile("\n|▁| *[^ \n▁]+| +")
_NEVER = (1 << 31) - 1
_ALL = (1 << 63) - 1


@dataclass
class Vocabulary:
    """Pieces by id; ``rank`` orders the pieces that merges may make, best first; ``byte`` has the ids of the byte pieces."""

    pieces: list[bytes]
    rank: dict[str, int]
    ids: dict[str, int]
    byte: list[int]


def load(model_path: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece BPE model with byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    names = [model.id_to_piece(k) for k in range(n)]
    byte = [-1] * 256
    pieces, usable = [], []
    for k, name in enumerate(names):
        if model.is_byte(k):
            byte[int(name[3:5], 16)] = k
            pieces.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            pieces.append(b"")
        else:
            pieces.append(name.replace(SPACE, " ").encode())
            usable.append(k)
    if min(byte) < 0:
        raise ValueError("the model has no byte pieces, so not every text can be encoded")
    if any("\n" in names[k] or SPACE in names[k].lstrip(SPACE) for k in usable):
        raise ValueError("the model has pieces over the bounds of words")
    usable.sort(key=lambda k: (-model.get_score(k), k))
    return Vocabulary(pieces, {names[k]: r for r, k in enumerate(usable)}, {names[k]: k for k in usable}, byte)


class Pairs:
    """For arrays: the rank of the piece that two adjacent pieces make, and the piece of a character."""

    def __init__(self, v: Vocabulary):
        found = {}
        for name, r in v.rank.items():
            for k in range(1, len(name)):
                a, b = v.ids.get(name[:k]), v.ids.get(name[k:])
                if a is not None and b is not None:
                    found[a << 32 | b] = r
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()], np.int32)
        self.made = np.array([v.ids[name] for name in v.rank], np.int32)
        self.of_char = np.full(1 << 16, -1, np.int32)
        for name, k in v.ids.items():
            if len(name) == 1 and ord(name) < 1 << 16:
                self.of_char[ord(name)] = k

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((b >= 0) & (self.keys[at] == key), self.ranks[at], _NEVER)


class Encoder:
    """Encodes texts; keeps what it found for frequent units.

    Drops are the bits of a number: bit k says whether the candidate that comes up as number k is skipped. What is
    kept of a unit is a tree: its root is the segmentation without drops, and the child k of a node is that
    with candidate k skipped too, k being above all that the node skips. A node knows how many candidates come up.
    """

    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED):
        self.v, self.seed, self.dropout = vocabulary, seed, dropout
        self.dropping = dropout > 0
        #: How many different drops a short unit can have.
        self.variants = 1 << 63 if self.dropping else 1
        # Eight drops by each 16 bits of a keyed hash: a table that the seed fills.
        bits = np.random.Generator(np.random.PCG64(seed)).random((1 << 16, 8)) < dropout
        self.drop = (bits << np.arange(8)).sum(1).astype(np.int64)
        self.pairs = Pairs(vocabulary)
        self.token = {name: np.int32(k).tobytes() for name, k in vocabulary.ids.items()}
        self.byte_token = [np.int32(k).tobytes() for k in vocabulary.byte]
        self._forget()

    def _forget(self) -> None:
        """Start the trees anew."""
        self.roots: dict[str, int] = {}
        self.units: list[str] = []
        self.size = 0
        #: By node: bits of the candidates that come up, those skipped, where its ids are, and its children.
        self.seen, self.met, self.begin, self.length = (np.zeros(1024, np.int64) for _ in range(4))
        self.child = np.full((1024, BRANCHES), -1, np.int32)
        self.pool, self.filled = np.zeros(1 << 14, np.int32), 0
        #: Once KEPT are kept: their number, ids in the pool, and the links to nodes that are not.
        self.full: tuple[int, int] | None = None
        self.loose: list[tuple[np.ndarray, np.ndarray]] = []

    def _trim(self, n: int) -> None:
        """Once KEPT segmentations are kept, more last for one call only; if ``n`` units needed many more, the texts have changed, and it starts anew."""
        if self.full is None:
            if self.size >= KEPT:
                self.full = self.size, self.filled
            return
        size, filled = self.full
        if self.size - size > 0.35 * n + 1000:
            self._forget()
            return
        for at, turn in self.loose:
            self.child[at[at < size], turn[at < size]] = -1
        for k in (np.flatnonzero(self.met[size : self.size] == 0) + size).tolist():
            del self.roots[self.units[k]]
        self.child[size : self.size] = -1
        del self.units[size:]
        self.size, self.filled, self.loose = size, filled, []

    def _short(self, text: str, drops: int) -> list[str]:
        return self._turns(text, drops)[0]

    def _turns(self, text: str, drops: int) -> tuple[list[str], int]:
        """Pieces and single characters of one unit, and how many candidates came up."""
        rank, turns = self.v.rank.get, 0
        parts = list(text)
        agenda = [rank(text[k : k + 2], _NEVER) for k in range(len(text) - 1)]
        while agenda:
            r = min(agenda)
            if r == _NEVER:
                break
            k = agenda.index(r)
            turns += 1
            if drops >> turns - 1 & 1:
                agenda[k] = _NEVER
                continue
            part = parts[k] = parts[k] + parts.pop(k + 1)
            del agenda[k]
            if k:
                agenda[k - 1] = rank(parts[k - 1] + part, _NEVER)
            if k < len(agenda):
                agenda[k] = rank(part + parts[k + 1], _NEVER)
        return parts, turns

    def _long(self, text: str, drops: int | bytes) -> list[str]:
        """Pieces and single characters of one unit; ``drops`` may also be a byte for each turn."""
        rank, n = self.v.rank, len(text)
        if isinstance(drops, int):
            drops = bytes(drops >> k & 1 for k in range(3 * n))
        turn = -1
        end, start = list(range(1, n + 1)), list(range(n))  # end[k]: of the part that begins at k; start[k]: of the part that ends before k + 1
        heap = [(r, k, k + 1, k + 2) for k in range(n - 1) if (r := rank.get(text[k : k + 2])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            r, a, b, c = heapq.heappop(heap)
            if gone[a] or (b < n and gone[b]) or end[a] != b or end[b] != c:
                continue
            turn += 1
            if drops[turn]:
                continue
            gone[b], end[a], start[c - 1] = 1, c, a
            if a:
                p = start[a - 1]
                if (r := rank.get(text[p:c])) is not None:
                    heapq.heappush(heap, (r, p, a, c))
            if c < n and (r := rank.get(text[a : end[c]])) is not None:
                heapq.heappush(heap, (r, a, c, end[c]))
        parts, k = [], 0
        while k < n:
            parts.append(text[k : end[k]])
            k = end[k]
        return parts

    def _ids(self, parts: list[str]) -> bytes:
        token = self.token
        return b"".join([token[part] if part in token else b"".join([self.byte_token[b] for b in part.encode()]) for part in parts])

    def _unit(self, unit: str, drops: int) -> bytes:
        """The ids of one short unit."""
        return self._found(unit, drops)[0]

    def _found(self, unit: str, drops: int) -> tuple[bytes, int]:
        """The ids of one short unit, and how many candidates came up."""
        if unit == SPACE:
            return b"".join(self.byte_token[b] for b in unit.encode()), 0
        parts, turns = self._turns(unit.replace(" ", SPACE), drops)
        return self._ids(parts), turns

    def _long_unit(self, unit: str, key: int) -> bytes:
        """The ids of one long unit, whose drops come from the hash ``key`` of its occurrence."""
        turns = 3 * len(unit)
        if self.dropping:
            h = mix(np.arange(turns, dtype=np.uint64) * BASE + np.uint64(key)) >> np.uint64(11)
            drops = (h < np.uint64(int(self.dropout * (1 << 53)))).tobytes()
        else:
            drops = bytes(turns)
        return self._ids(self._long(unit.replace(" ", SPACE), drops))

    def _many(self, units: list[str], drops: list[int]) -> list[bytes]:
        at = self._add(units, np.array(drops, np.int64))
        return [self.pool[a : a + n].tobytes() for a, n in zip(self.begin[at].tolist(), self.length[at].tolist(), strict=True)]

    def _all_found(self, part: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of short units, one after the other, how many each has, and how many candidates came up.

        ``part`` holds a unit a row, its characters as pieces, then -1. In each round every unit handles the top of its agenda.
        """
        pairs, (n, width) = self.pairs, part.shape
        turns = np.zeros(n, np.int64)
        agenda = np.full((n, width), _NEVER, np.int32)
        agenda[:, :-1] = pairs.rank(part[:, :-1], part[:, 1:])
        row = np.arange(n)
        column = np.arange(width)
        while len(row):
            now = agenda if len(row) == n else agenda[row]
            k = now.argmin(1)
            r = now[np.arange(len(row)), k]
            live = r < _NEVER
            row, k, r = row[live], k[live], r[live]
            skip = (bits[row] >> turns[row]) & 1 > 0
            turns[row] += 1
            agenda[row[skip], k[skip]] = _NEVER
            m, k, r = row[~skip], k[~skip], r[~skip]
            # What stands after the merged pair moves one place to the left.
            take = np.minimum(column + (column > k[:, None]), width - 1) + (m * width)[:, None]
            for a, end in ((part, -1), (agenda, _NEVER)):
                moved = a.ravel()[take]
                moved[:, -1] = end
                a[m] = moved
            part[m, k] = pairs.made[r]
            agenda[m, k] = pairs.rank(part[m, k], part[m, np.minimum(k + 1, width - 1)])
            agenda[m[k == width - 1], width - 1] = _NEVER
            left = k > 0
            agenda[m[left], k[left] - 1] = pairs.rank(part[m[left], k[left] - 1], part[m[left], k[left]])
        real = part >= 0
        return part[real], real.sum(1), turns

    def _room(self, nodes: int, ids: int) -> None:
        """Let the trees have room for so many nodes and ids more."""
        if (short := self.size + nodes - len(self.seen)) > 0:
            short += (self.size + nodes) // 4
            self.seen, self.met, self.begin, self.length = (np.concatenate([x, np.zeros(short, np.int64)]) for x in (self.seen, self.met, self.begin, self.length))
            self.child = np.concatenate([self.child, np.full((short, BRANCHES), -1, np.int32)])
        if self.filled + ids > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(self.filled // 4 + ids, np.int32)])

    def _add(self, units: list[str], drops: np.ndarray) -> np.ndarray:
        """New nodes of short units by their drops; their numbers follow each other."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        start = np.cumsum(sizes) - sizes
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        piece = self.pairs.of_char[np.where(points == 32, ord(SPACE), np.minimum(points, (1 << 16) - 1))]
        # Characters without a piece of their own become bytes, one unit at a time.
        piece[(points >= (1 << 16) - 1) | (points == ord(SPACE))] = -1
        odd = np.minimum.reduceat(piece, start) < 0
        self._room(len(units), len(points) * 4)
        at = np.arange(self.size, self.size + len(units))
        self.met[at] = drops

        def put(nodes, ids, length, turns) -> None:
            ends = self.filled + np.cumsum(length)
            self.length[nodes], self.begin[nodes], self.seen[nodes] = length, ends - length, (np.int64(1) << turns) - 1
            self.pool[self.filled : ends[-1]] = ids
            self.filled = int(ends[-1])

        for k in np.flatnonzero(odd).tolist():
            ids, turns = self._found(units[k], int(drops[k]))
            put(at[k : k + 1], np.frombuffer(ids, np.int32), np.array([len(ids) // 4]), np.array([turns]))
        plain = np.flatnonzero(~odd)
        plain = plain[np.argsort(sizes[plain], kind="stable")]
        for a in range(0, len(plain), 4096):
            some = plain[a : a + 4096]
            column = np.arange(sizes[some[-1]])
            part = np.where(column < sizes[some, None], piece[np.minimum(start[some, None] + column, len(piece) - 1)], np.int32(-1))
            put(at[some], *self._all_found(part, drops[some]))
        self.units += units
        self.size += len(units)
        return at

    def _down(self, node: np.ndarray, drops: np.ndarray) -> dict[int, bytes]:
        """Lead the roots in ``node`` to the nodes of their drops; what has no node is given by its place.

        Up to the first drop all is as without one; up to the second as with the first only, and so on.
        """
        apart: dict[int, bytes] = {}
        moving = np.flatnonzero(drops & self.seen[node])
        while len(moving):
            at = node[moving]
            left = drops[moving] & self.seen[at] & ~self.met[at]
            moving, at, left = moving[left != 0], at[left != 0], left[left != 0]
            if not len(moving):
                break
            low = left & -left
            bit = np.frexp(low.astype(np.float64))[1] - 1
            far = bit >= BRANCHES
            for k in moving[far].tolist():
                apart[k] = self._unit(self.units[node[k]], int(drops[k]))
            moving, at, bit = moving[~far], at[~far], bit[~far]
            to = self.child[at, bit]
            missing = np.flatnonzero(to < 0)
            if len(missing):
                ways, back = np.unique(at[missing] * 64 + bit[missing], return_inverse=True)
                above, turn = ways >> 6, ways & 63
                new = self._add([self.units[a] for a in above.tolist()], self.met[above] | np.int64(1) << turn)
                self.child[above, turn] = new
                if self.full is not None:
                    self.loose.append((above, turn))
                to[missing] = new[back]
            node[moving] = to
        return apart

    def _drops(self, sizes: np.ndarray, documents: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The drops of each occurrence of a unit, by its document and place there, and its hash."""
        with np.errstate(over="ignore"):
            key = mix(place.astype(np.uint64) + mix(documents.astype(np.uint64) * BASE + np.uint64(self.seed)))
        if not self.dropping:
            return np.zeros(len(sizes), np.int64), key

        def bits(h):
            parts = [self.drop[(h >> np.uint64(16 * k)) & np.uint64(0xFFFF)] << (8 * k) for k in range(4)]
            return parts[0] | parts[1] | parts[2] | parts[3]

        drops = bits(key)
        # Up to 11 characters have 30 candidates at most.
        more = np.flatnonzero(sizes > 11)
        if len(more):
            drops[more] |= (bits(mix(key[more] + BASE)) << 32) & _ALL
        return drops, key

    def encode_many(self, texts: list[str], documents: list[int]) -> list[bytes]:
        """The ids of the pieces of each text, as 32-bit numbers. A long text goes by parts of its units, which count on."""
        if len(texts) == 1 and len(texts[0]) > TOGETHER:
            units = map(re.Match.group, _UNITS.finditer(" " + texts[0]))
            found, place = [], 0
            while part := list(itertools.islice(units, PART)):
                found.append(self._ids_of(part, np.full(len(part), documents[0], np.int64), np.arange(place, place + len(part)))[0].tobytes())
                place += len(part)
            return [b"".join(found)]
        units, rows = [], [0]
        for text in texts:
            if text:
                units += _UNITS.findall(" " + text)
            rows.append(len(units))
        if not units:
            return [b""] * len(texts)
        rows = np.array(rows)
        of = np.repeat(np.arange(len(texts)), np.diff(rows))
        out, ends = self._ids_of(units, np.array(documents, np.int64)[of], np.arange(len(units)) - rows[of])
        bounds = np.concatenate([[0], ends])[rows]
        return [out[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def _ids_of(self, units: list[str], documents: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces of units that stand at a place of a document, one after the other, and where each unit's ids end."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        drops, key = self._drops(sizes, documents, places)
        get = self.roots.get
        node = np.array([get(u, -1) for u in units])
        new = {units[k]: None for k in np.flatnonzero((node < 0) & (sizes <= SHORT)).tolist()}
        if new:
            self.roots.update(zip(new, self._add(list(new), np.zeros(len(new), np.int64)).tolist(), strict=True))
            holes = np.flatnonzero((node < 0) & (sizes <= SHORT))
            node[holes] = [get(units[k]) for k in holes.tolist()]
        short = np.flatnonzero(node >= 0)
        led = node[short]
        apart = {int(short[k]): ids for k, ids in self._down(led, drops[short]).items()}
        node[short] = led
        for k in np.flatnonzero(node < 0).tolist():
            apart[k] = self._long_unit(units[k], int(key[k]))
        length = np.where(node >= 0, self.length[node], 0)
        for k, ids in apart.items():
            length[k] = len(ids) // 4
        ends = np.cumsum(length)
        out = self.pool[np.repeat(self.begin[node] - ends + length, length) + np.arange(ends[-1])] if not apart else self._with(apart, node, length, ends)
        self._trim(len(units))
        return out, ends

    def _with(self, apart: dict[int, bytes], node: np.ndarray, length: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ids of all units where some are not in the pool."""
        begin = self.begin[node]
        begin[list(apart)] = 0
        index = np.repeat(begin - ends + length, length) + np.arange(ends[-1])
        out = self.pool[np.minimum(index, len(self.pool) - 1)]
        for k, ids in apart.items():
            out[ends[k] - length[k] : ends[k]] = np.frombuffer(ids, np.int32)
        return out

    def encode(self, text: str, document: int) -> bytes:
        return self.encode_many([text], [document])[0]


#: Characters of texts that are encoded together; units or pieces of a longer text that are handled at once.
TOGETHER, PART = 1 << 20, 1 << 18


def decoded(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The text of the ids: the pieces less the space put before the first."""
    return b"".join(map(vocabulary.pieces.__getitem__, ids))[1:].decode("utf-8", "replace")


def restores(pieces: list[bytes], ids: bytes, text: str) -> bool:
    """Whether the ids decode to the text."""
    numbers, want, at = np.frombuffer(ids, np.int32), (" " + text).encode() if text else b"", 0
    for a in range(0, len(numbers), PART):
        part = b"".join(map(pieces.__getitem__, numbers[a : a + PART].tolist()))
        if not want.startswith(part, at):
            return False
        at += len(part)
    return at == len(want)


_encoders: dict[tuple, Encoder] = {}


def _encoder(shared, dropout: float, seed: int) -> Encoder:
    """This worker's encoder, kept from task to task."""
    key = (shared.value[0], dropout, seed)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value[1], dropout, seed)
    return _encoders[key]


def _shared(spark: SparkSession, model_path: str):
    """The vocabulary, which is of fixed size, on all executors; they need no file."""
    return spark.sparkContext.broadcast((model_path, load(model_path)))


def encode_documents(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", epoch_col: str | None = None) -> DataFrame:
    """``docs`` with three more columns: ids (of the pieces), n_pieces, and lossless, whether ids decode to the text.

    Columns of these names in ``docs`` are replaced. Null and empty texts have no pieces and are lossless. The same seed,
    id, epoch (from 1; 1 if there is no such column) and text always give the same ids; a null id counts as 0; rows of equal id, epoch and
    text have equal ids. Texts of any length are encoded whole.
    """
    small_batches(docs)
    shared = _shared(docs.sparkSession, model_path)
    kept = [c for c in docs.columns if c.lower() not in ("ids", "n_pieces", "lossless")]
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    if epoch_col:
        key = F.when(F.col(epoch_col) > 1, F.xxhash64(key, F.col(epoch_col))).otherwise(key)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], key.alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, dropout, seed)
        pieces = encoder.v.pieces
        for batch in batches:
            n = len(kept)
            found, lossless = [], []
            for a, b, _, _ in chunks(batch.column(n + 1), TOGETHER):
                texts = batch.column(n + 1).slice(a, b - a).to_pylist()
                for text, ids in zip(texts, encoder.encode_many(texts, batch.column(n).slice(a, b - a).to_pylist()), strict=True):
                    lossless.append(restores(pieces, ids, text))
                    found.append(ids)
            lengths = np.array([len(x) // 4 for x in found], np.int32)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], lists, pa.array(lengths), pa.array(lossless, pa.bool_())], [*kept, "ids", "n_pieces", "lossless"])

    added = [StructField("ids", ArrayType(IntegerType())), StructField("n_pieces", IntegerType()), StructField("lossless", BooleanType())]
    schema = StructType([*rows.schema.fields[: len(kept)], *added])
    return rows.mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model_path: str = MODEL, ids_col: str = "ids", into: str = "text") -> DataFrame:
    """``encoded`` with the text of ``ids_col`` as column ``into``; null ids give a null text."""
    shared = _shared(encoded.sparkSession, model_path)

    @F.pandas_udf("string")
    def text(column):
        vocabulary = shared.value[1]
        return column.map(lambda ids: None if ids is None else decoded(vocabulary, list(ids)))

    return encoded.withColumn(into, text(F.col(ids_col)))
