"""Language of texts and of spans of mixed text.

Letters of a word that belong to scripts narrow its candidate languages; hashed character n-grams then
score it for each of them, and a Viterbi pass over the words of a text, with a penalty for each
switch of language, labels every word. Runs of equal labels are the spans; the language with most letters
is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.llm.shared import small_batches
from tessera.llm.textops import BASE, chunks, hash_points, mix, runs

#: Labelled texts that the model is fitted on at most, chosen by a hash of their id.
SAMPLE = 6000
BITS = 16
ORDERS = (1, 2, 3, 4)
SWITCH = 6.0
#: Most that one word may say for one language over another.
WORD_CAP = 4.0
UNDETERMINED = "und"
#: Texts times languages up to which texts are labelled one by one.
APART = 64
#: A text is trusted as if it had so many more n-grams, all as likely as in its languages' own texts; short ones vary.
EASE = 20

#: First and last code points of letter ranges by script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x2AF), (0x1E00, 0x1EFF), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)],
    "greek": [(0x370, 0x373), (0x376, 0x37D), (0x386, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x481), (0x48A, 0x52F), (0x1C80, 0x1C88)],
    "armenian": [(0x531, 0x556), (0x561, 0x587)],
    "hebrew": [(0x5D0, 0x5EA)],
    "arabic": [(0x620, 0x64A), (0x66E, 0x6D3), (0x750, 0x77F), (0xFB50, 0xFDFB)],
    "devanagari": [(0x904, 0x939), (0x958, 0x961)],
    "bengali": [(0x985, 0x9B9)],
    "tamil": [(0xB85, 0xBB9)],
    "thai": [(0xE01, 0xE30)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
    "kana": [(0x3041, 0x3096), (0x30A1, 0x30FA)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
_BOUNDS = sorted((lo, hi, k + 1) for k, spans in enumerate(SCRIPTS.values()) for lo, hi in spans)
#: Script number of letters outside these ranges, and how many numbers there are, 0 for no letter included.
OTHER = len(SCRIPTS) + 1
N_SCRIPTS = OTHER + 1
_LOW, _HIGH, _SCRIPT = (np.array(x) for x in zip(*_BOUNDS, strict=True))
_SMALL = np.zeros(0x3000, np.uint8)
for _lo, _hi, _s in _BOUNDS:
    _SMALL[_lo : _hi + 1] = _s
_FOLD = np.arange(0x3000, dtype=np.uint32)
for _c in range(0x3000):
    _l = chr(_c).lower()
    if len(_l) == 1:
        _FOLD[_c] = ord(_l)
    if not _SMALL[_c] and chr(_c).isalpha():
        _SMALL[_c] = OTHER


def script_of(cp: np.ndarray) -> np.ndarray:
    """Number of the script of each code point, 0 for what is no letter."""
    out = _SMALL[np.minimum(cp, len(_SMALL) - 1)]
    rare = np.flatnonzero(cp >= len(_SMALL) - 1)
    if len(rare):
        at = np.searchsorted(_LOW, cp[rare], "right") - 1
        known = cp[rare] <= _HIGH[at]
        different, back = np.unique(cp[rare], return_inverse=True)
        letter = np.array([chr(c).isalpha() for c in different.tolist()])[back]
        out[rare] = np.where(known, _SCRIPT[at], np.where(letter, OTHER, 0))
    return out


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 rows as code points, and the offsets of rows in them."""
    lead = (data & 0xC0) != 0x80
    position = np.concatenate([[0], np.cumsum(lead)])
    return np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32), position[off]


def words_of(column: pa.Array) -> Iterator[tuple]:
    """First and end row of a chunk, its folded code points and their scripts, word starts and ends, and the
    offsets of rows in the words and in the code points. A word is a run of letters."""
    for a, b, data, off in chunks(column, 1 << 19):
        cp, rows = code_points(data, off)
        script = script_of(cp)
        yield a, b, np.where(cp < len(_FOLD), _FOLD[np.minimum(cp, len(_FOLD) - 1)], cp), script, *runs(script > 0, rows), rows


def _grams(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: buckets of the n-grams of the words, ends marked by a blank, and the word each is of."""
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths + 2)])
    padded = np.full(at[-1], 32, np.uint64)
    word = np.repeat(np.arange(len(starts)), lengths)
    inside = np.arange(len(word)) - np.repeat(at[:-1] - 2 * np.arange(len(starts)), lengths)
    padded[at[word] + 1 + inside] = cp[starts[word] + inside]
    owner = np.repeat(np.arange(len(starts)), lengths + 2)
    room = at[owner + 1] - np.arange(at[-1])
    h = np.zeros(at[-1], np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(h) - (n > 1)
        h = h[:m] * BASE + padded[n - 1 : n - 1 + m] + np.uint64(1) if n > 1 else padded * BASE + np.uint64(1)
        fits = np.flatnonzero(room[: len(h)] >= n)
        if n in ORDERS:
            yield (mix(h[fits] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64), owner[fits]


class LanguageModel:
    """Log probabilities of n-gram buckets by language, their mean in a language's own texts, and the languages of each script."""

    def __init__(self, languages: list[str], table: np.ndarray, own: np.ndarray, allowed: np.ndarray):
        self.languages, self.table, self.own, self.allowed = languages, table, own, allowed

    def known(self, script: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether any language uses the script of each word."""
        return self.allowed.any(1)[script[starts]]

    def scores(self, cp: np.ndarray, script: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, languages): log likelihood less the best one's, at least -WORD_CAP; languages of other scripts have the least.

        Also the log likelihoods themselves, and how many n-grams each word has.
        """
        # Each different word once.
        _, some, back = np.unique(hash_points(cp, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[some], ends[some]
        total = np.zeros((len(starts), len(self.languages)), np.float32)
        count = np.zeros(len(starts), np.float32)
        for bucket, owner in _grams(cp, starts, ends):
            edge = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[edge]] += np.add.reduceat(self.table[bucket], edge, axis=0)
            count += np.bincount(owner, minlength=len(starts))
        whole = total
        # Grams of one word overlap, so they count as fewer independent ones.
        total = whole / np.sqrt(np.maximum(count, 1))[:, None]
        ok = self.allowed[script[starts]]
        total = np.where(ok, total, -np.inf)
        none = ~ok.any(1)
        total[none] = 0
        total -= total.max(1, keepdims=True)
        return np.maximum(total, -WORD_CAP)[back], whole[back], count[back]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of the fit sample: (lang, bucket, n) of one task, scripts as negative buckets."""
    totals: dict[str, np.ndarray] = {}
    scripts = N_SCRIPTS
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for a, b, cp, script, starts, ends, rows, _ in words_of(batch.column(0)):
            for k in range(a, b):
                s, e = starts[rows[k - a] : rows[k - a + 1]], ends[rows[k - a] : rows[k - a + 1]]
                into = totals.setdefault(langs[k], np.zeros(scripts + (1 << BITS)))
                if len(s):
                    into[:scripts] += np.bincount(script[s], minlength=scripts)
                    for bucket, _ in _grams(cp, s, e):
                        into[scripts:] += np.bincount(bucket, minlength=1 << BITS)
    for lang, into in totals.items():
        at = np.flatnonzero(into)
        yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(at)), "bucket": at, "n": into[at]})


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> LanguageModel | None:
    """A model from at most ``sample`` labelled rows of ``docs``; None if no row has a label and letters.

    The counts that reach the driver number at most (scripts + 2**BITS) for each language of the sample.
    """
    small_batches(docs)
    chosen = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.col(id_col).alias("id"))
    ids = chosen.select("h", "id").orderBy("h", "id").limit(sample)
    cut = ids.agg(F.max("h").alias("cut"))
    rows = chosen.join(F.broadcast(cut), F.col("h") <= F.col("cut")).select("text", "lang")
    counted = rows.mapInArrow(_count, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return None
    languages = sorted(set(counted["lang"]), key=lambda x: x.encode())
    if len(languages) > np.iinfo(np.int16).max:
        raise ValueError(f"{len(languages)} languages are too many")
    scripts = N_SCRIPTS
    table = np.zeros((scripts + (1 << BITS), len(languages)))
    table[counted["bucket"], counted["lang"].map({x: k for k, x in enumerate(languages)})] = counted["n"]
    by_script, grams = table[:scripts], table[scripts:]
    allowed = by_script > 0.001 * by_script.sum(0, keepdims=True)
    log = np.log((grams + 0.5) / (grams.sum(0, keepdims=True) + 0.5 * (1 << BITS)))
    own = (grams * log).sum(0) / np.maximum(grams.sum(0), 1)
    return LanguageModel(languages, log.astype(np.float32), own.astype(np.float32), allowed)


def viterbi(scores: np.ndarray, rows: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word; ``rows`` are the offsets of texts in the words.

    All texts step together; where few go on, each of those goes on by itself, with the same sums.
    """
    n_words, n_lang = scores.shape
    length = np.diff(rows)
    order = np.argsort(-length, kind="stable")
    begin, length = rows[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps), "left")  # texts longer than each step
    steps = int(np.searchsorted(-alive * n_lang, -APART, "right"))
    best = np.zeros((len(order), n_lang))
    origin = np.zeros((n_words, n_lang), np.int16)
    stay = np.arange(n_lang, dtype=np.int16)
    for t in range(steps):
        k = alive[t]
        at = begin[:k] + t
        now = best[:k]
        if t:
            top = now.argmax(1)
            jump = now[np.arange(k), top] - switch
            moved = now < jump[:, None]
            origin[at] = np.where(moved, top[:, None].astype(np.int16), stay)
            now = np.where(moved, jump[:, None], now)
        best[:k] = now + scores[at]
    label = np.zeros(n_words, np.int16)
    state = best.argmax(1).astype(np.int16)
    for j in range(alive[steps] if steps < len(alive) else 0):
        first = begin[j] + steps
        label[first : begin[j] + length[j]], state[j] = _alone(scores[first : begin[j] + length[j]], best[j], switch, steps == 0)
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        label[at] = state[:k]
        if t:
            state[:k] = origin[at, state[:k]]
    return label


def _alone(scores: np.ndarray, best: np.ndarray, switch: float, fresh: bool) -> tuple[np.ndarray, int]:
    """The best labels of the words of one text from ``best`` on, and the label before them; ``fresh``: there is none."""
    now, back = best.tolist(), []
    for word in scores.tolist():
        high = max(now)
        jump = high - switch
        if fresh or min(now) >= jump:
            fresh = False
            back.append(None)
            now = [x + s for x, s in zip(now, word)]  # noqa: B905
        else:
            top = now.index(high)
            back.append([top if x < jump else k for k, x in enumerate(now)])
            now = [(jump if x < jump else x) + s for x, s in zip(now, word)]  # noqa: B905
    at, out = now.index(max(now)), []
    for came in reversed(back):
        out.append(at)
        if came is not None:
            at = came[at]
    return np.array(out[::-1], np.int16), at


def _predict(model: LanguageModel | None, spans: bool, sure: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, confidence, parts = [], [], [], []
            for a, b, cp, script, starts, ends, rows, row_cp in words_of(batch.column(1)):
                if model is None:
                    lang += [UNDETERMINED] * (b - a)
                    score += [0.0] * (b - a)
                    confidence += [0.0] * (b - a)
                    parts += [[] for _ in range(b - a)]
                    continue
                n_lang = len(model.languages)
                s, whole, count = model.scores(cp, script, starts, ends)
                label = viterbi(s, rows)
                row = np.repeat(np.arange(b - a), np.diff(rows))
                label = label.astype(np.int64)
                known = model.known(script, starts)
                letters = np.bincount(row * n_lang + label, (ends - starts) * known, (b - a) * n_lang).reshape(b - a, n_lang)
                all_letters = np.bincount(row, ends - starts, b - a)
                count = count * known
                below = np.bincount(row, (whole[np.arange(len(label)), label] - model.own[label] * count) * known, b - a)
                grams = np.bincount(row, count, b - a)
                confidence += np.where(grams > 0, np.exp(np.minimum(below / (grams + EASE), 0)), 0).tolist()
                best = letters.argmax(1)
                share = letters.max(1) / np.maximum(all_letters, 1)
                lang += [model.languages[k] if n else UNDETERMINED for k, n in zip(best.tolist(), all_letters.tolist(), strict=True)]
                score += share.tolist()
                if spans:
                    for k in range(b - a):
                        lo, hi = rows[k], rows[k + 1]
                        first = lo + np.flatnonzero(np.diff(label[lo:hi], prepend=-1)) if hi > lo else np.zeros(0, int)
                        base = row_cp[k]
                        last = np.append(first[1:], hi)[: len(first)] - 1
                        parts.append([(model.languages[label[f]], int(starts[f] - base), int(ends[z] - base)) for f, z in zip(first, last, strict=True)])
            columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            names = ["doc_id", "lang_pred", "score"]
            if sure:
                columns.append(pa.array(confidence, pa.float64()))
                names.append("confidence")
            if spans:
                kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                columns.append(pa.array([[{"lang": x, "start": s, "end": e} for x, s, e in p] for p in parts], kind))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text", spans: bool = True) -> DataFrame:
    """doc_id, lang_pred, score and, if asked for, spans (lang, start, end in code points) of each row.

    ``score`` is the share of the text's letters that are in spans of the predicted language and in words of a
    script that some language uses; it is 0 where no word has such a script. Null texts and texts
    without letters, and all texts if the model is None, are ``und`` with score 0 and no spans. Whole texts of
    any length are labelled. Rows of equal id stay apart; other columns are not looked at.
    """
    small_batches(docs)
    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<lang: string, start: int, end: int>>" * spans
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_predict(model, spans), schema)


def identify_languages(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``predict`` for all rows, by a model fitted on rows that are not ``held_out``; adds held_out."""
    model = fit(docs.filter(~held_out), text_col, lang_col, id_col)
    return predict(docs, model, id_col, text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def predict_with(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and confidence of each row beside its columns, without a join.

    ``confidence``, 0 to 1, is how likely an n-gram of the text is in the languages of its words, as a geometric mean,
    against one of those languages' own texts, with ``EASE`` for short ones; 0 where no word has a script that some language uses.
    """
    small_batches(docs)
    at = docs.columns.index(text_col)
    label = _predict(model, spans=False, sure=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(at), batch.column(at).fill_null("")], ["id", "text"])
            found = next(label(iter([text])))
            yield pa.RecordBatch.from_arrays([*batch.columns, *found.columns[1:]], [*batch.schema.names, "lang_pred", "score", "confidence"])

    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("confidence", DoubleType())])
    return docs.mapInArrow(run, schema)
