"""Spelling variants, whitening and decontamination against plain versions, and on edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontamination, maintext, spelling, whitening
from tests.llm.test_operators import ODD_TEXTS, docs, frame, odd  # noqa: F401

# 11 Spelling variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def plain_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def plain_variants(rows):
    words = plain_words(rows)
    near = defaultdict(set)
    by_cut = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            cut = w[:k] + w[k + 1 :]
            by_cut[cut, k].add(w)
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    for same in by_cut.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(df).collect()}


def misspelt_texts(seed, stems, rows):
    rnd = random.Random(seed)
    letters = "abcdefgéñstr"
    pool = []
    for k in range(stems):
        word = "".join(rnd.choice(letters) for _ in range(rnd.randint(6, 10)))
        pool += [word] * (400 if k % 7 == 0 else 40)
        for _ in range(3):
            at = rnd.randrange(len(word))
            other = rnd.choice([word[:at] + word[at + 1 :], word[:at] + rnd.choice(letters) + word[at:], word[:at] + rnd.choice(letters) + word[at + 1 :]])
            pool += [other] * rnd.choice([2, 6, 12])
    rnd.shuffle(pool)
    step = -(-len(pool) // rows)
    return [" ".join(w.upper() if rnd.random() < 0.1 else w for w in pool[k : k + step]) for k in range(0, len(pool), step)]


@pytest.mark.parametrize("subtree", [4000, 40, 3])
def test_variants_are_those_of_a_plain_version(spark, monkeypatch, subtree):
    monkeypatch.setattr(spelling, "SUBTREE", subtree)
    texts = misspelt_texts(subtree, 12 if subtree == 3 else 60, 30)
    want = plain_variants(enumerate(texts))
    assert sum(v[0] is not None for v in want.values()) > 5 and any(v[1] != v[0] for v in want.values())
    assert variants(docs(spark, texts)) == want


def test_one_edit_is_that_of_a_plain_loop():
    rnd = random.Random(1)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 5))) for _ in range(200)} | {"é" * 6, "é" * 7, "éa" * 3}
    pairs = [(a, b) for a in words for b in words]
    left, right, size = spelling.Subtree._letters([a for a, _ in pairs])
    other, back, length = spelling.Subtree._letters([b for _, b in pairs])
    got = spelling.one_edit(*np.broadcast_arrays(left, other) if left.shape == other.shape else (left, other), size, length, right, back)
    edits = lambda w: {w[:k] + w[k + 1 :] for k in range(len(w))}
    for (a, b), fine in zip(pairs, got, strict=True):
        plain = a in edits(b) or b in edits(a) or (a != b and len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1)
        assert fine == plain == spelling._plain_one_edit(a, b), (a, b)


def test_checksums_of_runs():
    data = np.frombuffer(b"abcdefgh" * 30, np.uint8)
    starts, ends = np.array([0, 3, 5, 7]), np.array([2, 4, 5, 200])
    start = np.array([zlib.crc32(p) for p in (b"1:", b"", b"x", b"long:")], np.uint32)
    want = [zlib.crc32(data[s:e], int(c)) for s, e, c in zip(starts, ends, start, strict=True)]
    assert spelling.crc_after(start, data, starts, ends).tolist() == want


def test_variants_edges(spark, odd):  # noqa: F811
    assert variants(odd) == plain_variants([(r.doc_id, r.text) for r in odd.collect()])
    assert variants(docs(spark, [])) == {}
    long = "ab" * 40_000
    texts = [f"{long} {long}x {long[:-1]} ×÷×÷×÷ {'z' * 70} {'z' * 69}q"] * 6 + ["×÷×÷×÷"] * 40
    rows = [(None, t, "en", "s", 0) for t in texts] + [(7, t, "en", "s", 0) for t in texts]
    want = plain_variants([(r[0], r[1]) for r in rows])
    assert any(len(w) > 70_000 and v[3] == 2 for w, v in want.items())
    assert variants(frame(spark, rows)) == want


def test_a_word_at_the_end_of_a_text_does_not_meet_the_next(spark):
    assert variants(docs(spark, ["abcdef", "ghijkl"] * 6)) == plain_variants(enumerate(["abcdef", "ghijkl"] * 6))


# 12 Whitening


def plain_whitening(rows, components=8):
    """Whole numbers by Python, the rest by numpy."""
    kept = [(k, [math.floor(1024 * float(c)) + 100_000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[j] for _, x in kept) for j in range(d)]
    deviation = {k: sum((n * x[j] - sums[j]) ** 2 for j in range(d)) for k, x in kept}
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for _, x in kept])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    white = centred @ vectors[:, order] / np.sqrt(values[order])
    return n, deviation, {k: white[i] for i, (k, _) in enumerate(kept)}, values[order] / values.sum()


def held(spark, rows, kind="double"):
    return whitening.whiten_embeddings(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()


@pytest.mark.parametrize(("kind", "block"), [("double", 1 << 14), ("float", 70)])
def test_whitening(spark, monkeypatch, kind, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(500, 12)) * np.linspace(0.2, 2, 12) + rnd.normal(size=(500, 1))
    rows = [(k, v) for k, v in enumerate(base.astype(np.float32).astype(float).tolist())]
    rows += [(1000, None), (1001, [1.0] * 11 + [None]), (1002, [math.nan] * 12), (1003, [math.inf] + [0.0] * 11), (1004, [0.5])]
    got = held(spark, rows, kind)
    n, deviation, white, explained = plain_whitening([r for r in rows if r[0] != 1004])
    assert len(got) == 500 * 8 and {r.n for r in got} == {n} == {500}
    sign = {}
    for r in got:
        assert r.deviation == deviation[r.vec_id]
        want = white[r.vec_id][r.component - 1]
        sign.setdefault(r.component, 1 if r.whitened * want >= 0 else -1)
        assert r.whitened == pytest.approx(sign[r.component] * want, abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9


def test_scatter_is_exact_for_large_and_negative_numbers(spark):
    rnd = random.Random(2)
    x = [[rnd.randint(-(2**61), 2**61), rnd.randint(0, 3), 7, rnd.randint(-5, 2**40)] for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(3)
    low, high = [min(c) for c in zip(*x, strict=True)], [max(c) for c in zip(*x, strict=True)]
    bounds = whitening.dimension_bounds(df)
    assert bounds == [(300, sum(c), min(c), max(c)) for c in zip(*x, strict=True)]
    got = whitening.shifted_products(df, low, high, 300)
    assert got.tolist() == [[sum((a[i] - low[i]) * (a[j] - low[j]) for a in x) for j in range(4)] for i in range(4)]


def test_whitening_edges(spark):
    assert held(spark, []) == [] and held(spark, [(1, None), (2, [None])]) == [] and held(spark, [(1, [])]) == []
    one = held(spark, [(1, [0.5, 0.25])])
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = held(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (None, [0.0, 1.0])])
    assert Counter((r.vec_id, r.component) for r in flat) == Counter({(1, 1): 1, (1, 2): 1, (2, 1): 2, (2, 2): 2, (None, 1): 1, (None, 2): 1})
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and {abs(round(r.whitened, 9)) for r in flat if r.component == 1} == {1.0}
    wide = spark.createDataFrame([(str(k), [float(k % 3), float(k % 5)], k, "c") for k in range(30)], "vec_id string, embedding array<double>, n long, component string")
    assert whitening.whiten_embeddings(wide).count() == 60
    huge = held(spark, [(k, [k * 1e11, 0.0, -k * 3e9]) for k in range(9)])
    assert {r.deviation for r in huge if r.vec_id != 4} == {None} and all(r.identity_error < 1e-9 for r in huge)


# 13 Decontamination

ITEM_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def plain_contamination(texts, items):
    windows = defaultdict(set)
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        for p in range(len(w) - min(len(w), 10) + 1 if w else 0):
            windows[tuple(w[p : p + 10])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for p in range(len(w)):
            for n in sizes:
                if (ids := windows.get(tuple(w[p : p + n]))) is not None and p + n <= len(w):
                    hit |= set(range(p, p + n))
                    found |= {str(i) for i in ids if i is not None}
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def contamination(df, items):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontamination.contaminated_documents(df, items).collect())


def item_frame(spark, items):
    extra = spark.createDataFrame(items, "item_id long, text string")
    for name in ("row", "h", "n", "at", "window", "length", "doc_id"):
        extra = extra.withColumn(name, F.lit("clash"))
    return extra


def test_contamination_is_that_of_a_plain_version(spark):
    rnd = random.Random(6)
    word = lambda: rnd.choice(["a", "b", "the", "of", "Zoë", "x1", "99", "q"])
    items = [(k, " ".join(word() for _ in range(rnd.choice([0, 1, 2, 3, 5, 9, 10, 11, 25])))) for k in range(40)]
    items = [(k, t) for k, t in items if len(t.split()) not in (1, 2) or k < 3] + [(3, "third text of a repeated id"), (None, "words of an item without an id"), (77, None), (78, "…!?"), (79, items[5][1])]
    texts = []
    for _ in range(80):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 40)))]
        for _ in range(rnd.randint(0, 3)):
            parts.append(rnd.choice(items)[1] or "")
            parts.append(" ".join(rnd.choice(["u", "v", "w"]) for _ in range(rnd.randint(0, 9))))
        texts.append("\n-".join(parts).upper() if rnd.random() < 0.3 else ", ".join(parts))
    texts += [t + " end" for t in texts[:5]] + ["WORDS of an-item, without AN id" * 2, None, ""]
    want = plain_contamination(texts, items)
    assert contamination(docs(spark, texts).repartition(3), item_frame(spark, items)) == Counter((k, *r) for k, r in enumerate(want))


def test_spans_and_items_are_whole(spark):
    passage = " ".join(f"w{k}" for k in range(14))
    texts = [f"one {passage} two {passage.upper()} {' '.join(passage.split()[:9])}"]
    row = decontamination.find_contamination(docs(spark, texts), spark.createDataFrame([("b", passage), ("a", passage + " more")], "item_id string, text string")).first()
    assert [tuple(s) for s in row.spans] == [(1, 15), (16, 30)] and row["items"] == ["a", "b"] and row.n_words == 39


def test_contamination_edges(spark, odd):  # noqa: F811
    items = [(1, "a b c d e"), (2, "日本語 текст"), (3, "x " * 30), (4, "p")]
    rows = odd.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *w) for r, w in zip(rows, plain_contamination([r.text for r in rows], items), strict=True))
    assert contamination(odd, item_frame(spark, items)) == want
    assert sum(contamination(odd, item_frame(spark, [])).values()) == len(rows) and contamination(docs(spark, []), item_frame(spark, items)) == Counter()


def test_a_word_at_the_end_of_a_text_is_not_joined_to_the_next(spark):
    texts = ["one two", "three four five", "six"]
    items = [(1, "two three four"), (2, "three four five"), (3, "five six"), (4, "two")]
    assert contamination(docs(spark, texts).coalesce(1), item_frame(spark, items)) == Counter((k, *r) for k, r in enumerate(plain_contamination(texts, items)))


def test_common_shingles_and_copies(spark):
    common = "of the and of the and of the and of"
    texts = [common + " tail" for _ in range(300)] + [f"{k} of the and" for k in range(300)]
    items = [(k, common) for k in range(20)] + [(50, "of the and")]
    assert contamination(docs(spark, texts), item_frame(spark, items)) == Counter((k, *r) for k, r in enumerate(plain_contamination(texts, items)))


# 6 Main text of layouts that the labelled table does not have

_BODY = "<h1>Harbour to open again</h1><p>The harbour will open again in spring, the town said on Monday.</p><p>It was closed after the storm.</p><p>Repairs cost more than expected.</p>"
_TEXT = "Harbour to open again\nThe harbour will open again in spring, the town said on Monday.\nIt was closed after the storm.\nRepairs cost more than expected."
_TALK = "<p>Eva</p><p>I sail there every year and it is about time.</p><a href=#>Reply</a><p>Finn</p><p>Who pays for it in the end?</p><a href=#>Reply</a>"
_MENU = "<ul><li><a href=/>Home</a></li><li><a href=/t>Town and country</a></li></ul>"


@pytest.mark.parametrize("element", ["article", "main", "div", "div class=story", "td"])
@pytest.mark.parametrize(
    "page",
    [
        "<div class='page with-sidebar'>{}</div>",
        "<div class='header-fixed nav-open'>{}</div>",
        "<div id=social>{}</div>",
        "<form id=aspnetForm method=post>{}</form>",
        "<div class='menu-page'><div class='share widget'>{}</div></div>",
        "<div class='site'>" + "<nav>{menu}</nav>" + "{}<div class='footer'>Contact the town hall</div></div>",
        "<div class=modal-ready>{}<div class=modal>Please log in to go on reading.</div></div>",
        "<section id=login-wrapper role=search>{}<div>Copyright 2019 The Tide</div></section>",
    ],
)
def test_telling_names_on_wrappers(page, element):
    weights = maintext.train()
    inner = f"<table><tr><td>{_BODY}</td></tr></table>" if element == "td" else f"<{element}>{_BODY}</{element.split()[0]}>"
    assert maintext.main_text(page.replace("{menu}", _MENU).replace("{}", inner), weights) == _TEXT


@pytest.mark.parametrize("talk", ["<div id=talkback>{}</div>", "<div class=x9>{}</div>", "<ul class=comment-list><li>{}</li></ul>", "<section id=respond>{}</section>", "<div class='single comments-area'>{}</div>"])
@pytest.mark.parametrize("page", ["<article>{b}</article>{t}", "<div class=comments-on><main>{b}</main>{t}</div>", "<div><div>{b}</div>{t}</div>", "<article>{b}{t}</article>"])
def test_readers_are_left_out(page, talk):
    weights = maintext.train()
    assert maintext.main_text(page.format(b=_BODY, t=talk.format(_TALK)), weights) == _TEXT


def test_a_line_of_the_article_may_tell_of_rights():
    weights = maintext.train()
    assert maintext.main_text(f"<article>{_BODY}<p>All rights reserved.</p></article><footer>Us</footer>", weights) == _TEXT + "\nAll rights reserved."
