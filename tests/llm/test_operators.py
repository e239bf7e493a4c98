"""The ten operators against plain versions, and on edge cases: nulls, empty and very long texts, ties, repeats, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import ann, components, fingerprint, langid, maintext, mixing, neardup, pieces, pii, textops, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def docs(spark, texts, source=lambda k: f"s{k % 3}"):
    return frame(spark, [(k, t, "en", source(k), None if t is None else len(t)) for k, t in enumerate(texts)])


ODD_TEXTS = [None, "", " \n\t", "one", "a b c d", "a b c d e", "a b c d e", "é" * 10, "x " * 30_000, "日本語 текст 123 \U0001f600", "<p>&amp;</p>", "0" * 5000, "@" * 500 + "." * 500]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts with repeated rows, a null id, and columns whose names the operators use themselves."""
    rows = [(k, t, "en" if k % 2 else None, None if k % 3 == 0 else "s", None) for k, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id", "en", "s", None)]
    extra = frame(spark, rows)
    for name in ("size", "key", "id", "h", "u", "score", "slice", "rank", "label", "ids", "digest", "next", "row"):
        extra = extra.withColumn(name, F.lit("clash"))
    return extra


# 1 Mixing


def plain_mix(rows, cycle=3, epochs=3):
    size = {k: len(WORD.findall(t or "")) for k, t, s in rows}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = Counter()
    for k, _, s in rows:
        total[s] += size[k]
    weight = {s: i % cycle + 1 for i, s in enumerate(sources)}
    target, budget, free = {}, sum(total.values()), list(sources)
    left = budget
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] >= epochs * total[s]]
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = float(epochs * total[s])
            left -= epochs * total[s]
            free.remove(s)
    return size, total, target


def test_mix_targets_and_amounts(spark):
    rnd = random.Random(3)
    texts = ["w " * rnd.randint(0, 60) for _ in range(400)]
    source = lambda k: None if k % 17 == 0 else "big" if k % 3 else f"s{k % 5}"
    df = docs(spark, texts, source)
    size, total, target = plain_mix([(k, t, source(k)) for k, t in enumerate(texts)])
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(texts)
    taken = Counter()
    for r in got:
        assert r["size"] == size[r.doc_id] and r.source_size == total[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 2 * max(size.values()) for s in total)
    assert sum(taken.values()) <= sum(total.values())
    assert sorted(got) == sorted(mixing.mix_sources(df.repartition(5)).collect())
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.epochs for r in got)


def test_mix_cuts_time_until_few_rows_are_left(spark, monkeypatch):
    rnd = random.Random(9)
    df = docs(spark, [f"{k} " + "w " * rnd.randint(0, 20) for k in range(500)])
    whole = sorted(mixing.mix_sources(df).collect())
    for few, slices in ((3, 4), (0, 8), (10**9, 2)):
        monkeypatch.setattr(mixing, "FEW", few)
        monkeypatch.setattr(mixing, "TIME_SLICES", slices)
        assert sorted(mixing.mix_sources(df).collect()) == whole


def test_mix_with_late_times_is_that_of_one_sorted_queue(spark, monkeypatch):
    """Sources of one large document have finish times far beyond 2; slices of the order take more digits."""
    rnd = random.Random(10)
    texts = [f"{k} " + "w " * (4000 if k % 50 == 0 else rnd.randint(0, 30)) for k in range(400)]
    df = docs(spark, texts, lambda k: f"large{k}" if k % 50 == 0 else f"s{k % 7}")
    monkeypatch.setattr(mixing, "FEW", 0)
    monkeypatch.setattr(mixing, "TIME_SLICES", 4)
    monkeypatch.setattr(mixing, "LATE_SLICES", 1)
    monkeypatch.setattr(mixing, "SLICE_DIGITS", 1)
    monkeypatch.setattr(mixing, "SLICE_ROWS", 2)
    got = mixing.mix_sources(df).collect()
    target, total = {r.source: r.target for r in got}, {r.source: r.source_size for r in got}
    order = sorted((r.source, hashlib.md5(f"mix:{r.doc_id}:{hashlib.md5(texts[r.doc_id].encode()).hexdigest()}".encode()).hexdigest(), r.doc_id, r["size"]) for r in got if r["size"])
    upto, queue = Counter(), []
    for source, key, k, size in order:
        upto[source] += size
        queue += [((e * total[source] + upto[source]) / target[source], source.encode(), e, key, k, size) for e in range(3)]
    assert max(queue)[0] > 8
    taken, left = Counter(), sum(total.values())
    for _, _, _, _, k, size in sorted(queue):
        if size > left:
            break
        taken[k] += size
        left -= size
    assert {r.doc_id: r.taken for r in got if r.taken} == dict(taken)


def test_mix_of_rows_of_one_id(spark):
    texts = ["w " * (k % 7 + 1) + str(k) for k in range(300)]
    df = frame(spark, [(1, t, "en", "s" + str(k % 2), None) for k, t in enumerate(texts)])
    got = mixing.mix_sources(df).collect()
    assert len(got) == 300 and sum(r.taken for r in got) <= sum(r["size"] for r in got) <= sum(r.taken for r in got) + 30


def test_mix_edges(spark, odd):
    got = mixing.mix_sources(odd).collect()
    assert len(got) == odd.count() and all(r.taken == 0 for r in got if r["size"] == 0)
    assert mixing.mix_sources(odd.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix_sources(docs(spark, [None, ""])).collect()] == [0, 0]


# 2 Toxicity


def test_toxicity_learns_and_leaves_clean(spark, odd):
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(300)]
    rows = [" ".join(rnd.choices(words, k=40)) + (" you vile troll" if k % 4 == 0 else "") for k in range(600)]
    df = docs(spark, rows)
    labels = frame(spark, [(k, int(k % 4 == 0)) for k in range(0, 600)] + [(7, None)], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = toxicity.score_toxicity(df, labels, held).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held_rows = [r for r in got if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held_rows) >= 0.95 * len(held_rows)
    # What the labels of held-out rows say has no say.
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(got) == sorted(toxicity.score_toxicity(df, turned, held).collect())
    edge = toxicity.score_toxicity(odd, labels, held).collect()
    assert len(edge) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in edge)
    assert {r.score for r in toxicity.score_toxicity(df, labels.limit(0), held).collect()} == {0.5}
    assert toxicity.score_toxicity(df.limit(0), labels, held).count() == 0


def plain_features(text):
    """Buckets of words, pairs and pairs with a word between."""
    words = re.findall(rb"[0-9a-z\x80-\xff]+", text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
    each = [int(textops.hash_runs(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) for w in words]

    def bucket(h):
        for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D), (33, 1)):
            h = (h ^ h >> shift) * factor % 2**64
        return h >> 64 - toxicity.BITS

    found = {bucket((h + 1) % 2**64) for h in each}
    for gap in (1, 2):
        found |= {bucket((a * int(textops.BASE) + b + 2 + gap) % 2**64) for a, b in zip(each, each[gap:], strict=False)}
    return found


def plain_ftrl(examples, rounds):
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if i == "bias":
            return -z[i] / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - (1 if z[i] > 0 else -1) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(rounds):
        for x, y in examples:
            w = {i: weight(i) for i in [*sorted(x), "bias"]}
            g = (1 / (1 + np.exp(-max(-30, min(30, sum(w.values()))))) - y) * (toxicity.POSITIVE if y else 1.0)
            for i, wi in w.items():
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA * wi
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_ftrl_is_that_of_a_plain_loop(spark):
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(60)] + ["Foo9", "bär"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 30))) + (" vile! TROLL" if k % 3 == 0 else "") for k in range(120)]
    batch = pa.RecordBatch.from_pydict({"h": list(range(120)), "y": [int(k % 3 == 0) for k in range(120)], "text": texts, "label_id": [str(k) for k in range(120)]})
    (featured,) = toxicity._featurise(iter([batch]))
    lists = [set(x) for x in featured.column(3).to_pylist()]
    assert lists == [plain_features(t) for t in texts]
    got = toxicity.train([np.array(sorted(x), np.int64) for x in lists], np.array([float(k % 3 == 0) for k in range(120)]))
    want = plain_ftrl([(x, float(k % 3 == 0)) for k, x in enumerate(lists)], toxicity.ROUNDS)
    assert got.bias == pytest.approx(want.pop("bias"), abs=1e-9) and len(got.bucket) > 3
    assert dict(zip(got.bucket.tolist(), got.weight.tolist(), strict=True)) == pytest.approx({i: w for i, w in want.items() if w}, abs=1e-9)
    weights = dict(zip(got.bucket.tolist(), got.weight.tolist(), strict=True))
    for r in toxicity.score(docs(spark, [*texts[:20], None, ""]), got).collect():
        total = got.bias + sum(weights.get(i, 0.0) for i in plain_features([*texts[:20], "", ""][r.doc_id]))
        assert r.score == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)


def test_several_texts_of_a_labelled_id_count_once(spark):
    df = frame(spark, [(k % 10, f"word{k} common", "en", "s", None) for k in range(400)])
    labels = frame(spark, [(k, int(k % 2 == 0)) for k in range(10)], "doc_id long, toxic int")
    a, b = (toxicity.fit(df.repartition(n), labels) for n in (1, 7))
    assert a.bias == b.bias and a.bucket.tolist() == b.bucket.tolist() and a.weight.tolist() == b.weight.tolist()


# 3 PII


def plain_base(text):
    out = []
    for kind, p in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        out += [(m.start(), kind, m.end()) for m in re.finditer(p, text) if pii.passes(pii.KINDS[kind], m.group())]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(5)
    for _ in range(20_000):
        text = "".join(rnd.choice("0123456789..@@++-- ()ab%é") for _ in range(rnd.randint(0, 50)))
        assert pii.base_spans(text) == plain_base(text), text


def test_field_likelihood_and_gradient():
    lines = pii.labelled_table()[::40]
    names, data = pii.training_data(lines)
    rnd = np.random.default_rng(4)
    weight, trans = rnd.normal(size=(len(names), len(pii.STATES))) / 2, rnd.normal(size=(len(pii.STATES),) * 2) / 2
    value, grad_w, grad_t = pii.likelihood(weight, trans, data)
    plain = 0.0
    for words, states in (r for line in lines for r in pii.labelled_runs(line)):
        emit = np.array([weight[[names[f] for f in w]].sum(0) for w in words])
        ahead = trans[0] + emit[0]
        path = trans[0, states[0]] + emit[0, states[0]] + trans[states[-1], 0]
        for t in range(1, len(words)):
            ahead = np.logaddexp.reduce(ahead[:, None] + trans, axis=0) + emit[t]
            path += trans[states[t - 1], states[t]] + emit[t, states[t]]
        plain += path - np.logaddexp.reduce(ahead + trans[:, 0])
    assert value == pytest.approx(plain, rel=1e-9)
    for grad, at in ((grad_w, weight), (grad_t, trans)):
        for _ in range(40):
            k = tuple(rnd.integers(0, d) for d in at.shape)
            kept, sides = at[k], []
            for move in (1e-5, -1e-5):
                at[k] = kept + move
                sides.append(pii.likelihood(weight, trans, data)[0])
            at[k] = kept
            assert grad[k] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-4)


def labelled_over_all_words(field, text):
    """(place, kind) of the words that a Viterbi over every word of a text labels, in which words that are in no run are outside."""
    run_of = {place: run for run in pii.runs(text) for place in run}
    words = [m.span() for m in WORD.finditer(text)]
    best, origin = np.where(np.arange(len(pii.STATES)) == 0, 0.0, -np.inf), []
    for place in words:
        emit = np.where(np.arange(len(pii.STATES)) == 0, 0.0, -np.inf)
        inside = place in run_of
        if inside:
            run = run_of[place]
            emit = field.emissions([text[s:e] for s, e in run], pii.around(text, run[0][0], run[-1][1]))[run.index(place)]
        ways = best[:, None] + (field.trans if inside or np.isfinite(best[1:]).any() else 0)
        origin.append(ways.argmax(0))
        best = ways.max(0) + emit
    state, states = int((best + field.trans[:, 0]).argmax() if words and words[-1] in run_of else best.argmax()), []
    for back in reversed(origin):
        states.append(state)
        state = int(back[state])
    states.reverse()
    return [(place, (state - 1) // 2) for place, state in zip(words, states, strict=True) if state]


def test_runs_give_the_labels_of_all_words():
    field, rnd = pii.train(rounds=60), random.Random(8)
    pieces = ["call", "order", "and", "(212)", "555-0187", "+1", "-", "0171", "5550123", "a@b.de", "12", "1.2.3.4", "/", "Tel.:", "4111"]
    texts = [" ".join(rnd.choices(pieces, k=rnd.randint(0, 25))) for _ in range(300)]
    for text, spans in zip(texts, pii.field_spans(field, texts), strict=True):
        covered = {place for place, _ in labelled_over_all_words(field, text)}
        assert all(any(a < e and s < b for a, b in covered) for s, _, e in spans)
        assert all(any(a < e and s < b for s, _, e in spans) for a, b in covered if re.search(r"[0-9a-z]", text[a:b]))


def lines_of_other_forms(rnd, n):
    """(line, is it a phone number, number): sentences that the labelled table lacks, each number once as a phone and once as another number."""
    digits = lambda k: "".join(rnd.choices("123456789", k=k))
    forms = [lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)} {digits(3)} {digits(4)}", lambda: f"0{digits(3)} {digits(7)}", lambda: f"0{digits(2)}/{digits(7)}", lambda: f"0043 {digits(1)} {digits(4)} {digits(4)}"]
    phone = ["for questions please call the office, {} until noon", "you may phone her: {} (evenings)", "his new mobile: {}.", "our hotline {} answers day and night", "Telephone {}, ask for the manager", "if lost, dial {} at once", "Sie erreichen uns per Telefon: {}", "ring {} when you arrive"]
    other = ["we have shipped your order {} yesterday", "the invoice with number {} was never paid", "look for serial no. {} below the handle", "the table has rows {} only", "this gives a total of {} tons", "parts: part {} broke first", "die Bestellung {} kam an", "article {} of the catalogue", "a sum of {} was found"]
    for _ in range(n):
        number = rnd.choice(forms)()
        yield rnd.choice(phone).format(number), True, number
        yield rnd.choice(other).format(number), False, number


def test_one_number_as_phone_and_as_order_number():
    field = pii.train()
    lines = list(lines_of_other_forms(random.Random(12), 1000))
    found = [[t[s:e] for s, _, e in added] for (t, *_), (_, added) in zip(lines, pii.find_all(field, [t for t, *_ in lines]), strict=True)]
    hits = sum(x in f for f, (_, is_phone, x) in zip(found, lines, strict=True) if is_phone)
    given = sum(map(len, found))
    print(f"other forms: precision {hits / given:.3f}, recall {hits / 1000:.3f}")
    assert hits >= 0.95 * given and hits >= 950
    for text, number in (("sum 123 456 7890 total", ""), ("rows 415 555 2671 found", ""), ("serial 212-555-0187 part", ""), ("order 0171 5550123 shipped", ""), ("Tel. 030/5550123", "030/5550123"), ("ring (415)555-2671", "(415)555-2671"), ("0043 1 5550 1234", "0043 1 5550 1234")):
        ((_, added),) = pii.find_all(field, [text])
        assert [text[s:e] for s, _, e in added] == [number] * bool(number), text


def test_digits_of_any_script_do_no_harm(spark):
    field, rnd = pii.train(), random.Random(6)
    digits = [c for c in map(chr, range(0x110000)) if c.isdigit() or c.isnumeric()]
    texts = [f"version 1.2.3.{c} here +{c}{c * 9} {c * 4}-{c * 4} a@{c}.{c}" for c in digits] + ["version 1.2.3.\u00b2 here", "1.2.3.\u2460 9"]
    texts += ["".join(rnd.choice([*"0123456789.+-() @a", rnd.choice(digits)]) for _ in range(60)) for _ in range(2000)]
    found = pii.find_all(field, texts)
    assert [sorted(base) for base, _ in found] == [plain_base(t) for t in texts]
    df = docs(spark, texts[:300] + texts[-300:])
    assert pii.find_personal_data(df).count() == 600 and pii.mask_personal_data(df).filter("text is null").count() == 0


def held_out_lines(rnd, n):
    """(line, phone numbers in it) by rule, with numbers and words that the labelled table does not have."""
    digits = lambda k: "".join(rnd.choices("123456789", k=k))
    words = "river stone apple under light seven window paper garden often".split()
    forms = [lambda: f"{digits(3)}-{digits(3)}-{digits(4)}", lambda: f"({digits(3)}) {digits(3)}-{digits(4)}", lambda: f"{digits(3)} {digits(3)} {digits(4)}", lambda: f"0{digits(3)} {digits(7)}", lambda: f"0{digits(2)} {digits(4)} {digits(4)}"]
    others = [lambda: digits(4), lambda: f"{digits(2)} of {digits(3)}", lambda: f"{digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(2)}-{digits(2)}", lambda: f"19{digits(2)} and 20{digits(2)}", lambda: f"{digits(5)} {digits(4)}", lambda: f"{digits(8)}", lambda: f"({digits(4)})", lambda: f"{digits(3)}.{digits(2)}"]
    for _ in range(n):
        phones = [rnd.choice(forms)() for _ in range(rnd.randint(0, 2))]
        parts = phones + [rnd.choice(others)() for _ in range(rnd.randint(0, 3))]
        rnd.shuffle(parts)
        yield " ".join(f"{rnd.choice(words)} {x} {rnd.choice(words)}" for x in parts), phones


def test_added_spans_on_held_out_lines():
    lines = list(held_out_lines(random.Random(11), 1000))
    found = [[t[s:e] for s, _, e in added] for (t, _), (_, added) in zip(lines, pii.find_all(pii.train(), [t for t, _ in lines]), strict=True)]
    hits = sum((Counter(f) & Counter(p)).total() for f, (_, p) in zip(found, lines, strict=True))
    given, wanted = sum(map(len, found)), sum(len(p) for _, p in lines)
    print(f"precision {hits / given:.3f}, recall {hits / wanted:.3f}")
    assert hits >= 0.95 * given and hits >= 0.9 * wanted


def test_field_finds_what_the_base_misses_and_leaves_the_rest():
    field = pii.train()
    ((base, added),) = pii.find_all(field, ["ring (487) 555-7209, or a.b@c.example; order 1234567890123456 of 2020"])
    assert [(pii.KINDS[k]) for _, k, _ in base] == ["email"] and [pii.KINDS[k] for _, k, _ in added] == ["phone"]
    assert pii.masked("x a@b.de y", [(2, 0, 8)]) == "x [email] y"


def test_pii_table(spark, odd):
    texts = ["mail a@b.de or +1 (212) 555-0187", "10.0.0.1 and 4111 1111 1111 1111", None, "é a@b.de"]
    got = {r.doc_id: r for r in pii.find_personal_data(docs(spark, texts)).collect()}
    for k, t in enumerate(texts):
        base = plain_base(t or "")
        text = ",".join(f"{pii.KINDS[x]}:{s}:{e}" for s, x, e in base)
        assert got[k].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [got[k][f"n_{n}"] for n in pii.KINDS] == [sum(x == i for _, x, _ in base) for i in range(4)]
        assert set(filter(None, text.split(","))) <= set(got[k].spans.split(","))
    assert pii.find_personal_data(odd).count() == odd.count()
    masked = pii.mask_personal_data(odd)
    assert masked.columns == odd.columns and masked.count() == odd.count()
    assert pii.find_personal_data(odd.limit(0)).count() == 0


# 4 Near duplicates


def plain_components(rows):
    sets = {}
    for k, t in rows:
        w = WORD.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_near_duplicates_are_all_found(spark):
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=4)) for _ in range(500)]
    rows, k = [], 0
    for _ in range(25):
        base = rnd.choices(vocabulary, k=rnd.randint(60, 200))
        for _ in range(rnd.randint(1, 12)):
            words = list(base)
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            rows.append((k, " ".join(words).upper() if k % 2 else "\n".join(words)))
            k += 1
    common = " ".join(rnd.choices(vocabulary, k=60))
    rows += [(k + j, common + " " + " ".join(rnd.choices(vocabulary, k=rnd.randint(5, 60)))) for j in range(60)]
    rnd.shuffle(rows)
    want = plain_components(rows)
    got = neardup.near_duplicates(frame(spark, rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_templated_sets_of_one_key_are_split(spark, monkeypatch):
    """Many sets of one key in many components: all links are found, and rows stay near linear in the number of sets."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(3000)]
    template = rnd.choices(vocabulary, k=150)
    n, texts = 240, []
    monkeypatch.setattr(neardup, "CROWD", 64)
    for _ in range(n // 2):
        words = template + rnd.choices(vocabulary, k=90)
        twin = list(words)
        twin[rnd.randrange(200, 235)] = "twin"
        texts += [" ".join(words), " ".join(twin)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    docs_ = frame(spark, rows, "id long, text string")
    sets = {k: set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for k, t in rows}
    want = {(b, a) for a, b in itertools.combinations(sorted(sets), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(want) >= n // 2
    for k in range(0, n, 2):
        assert 0.3 < len(sets[k] & sets[0]) / len(sets[k] | sets[0]) <= 1
    # As if all of them met in one key.
    (batch,) = neardup._long_signatures(iter([pa.RecordBatch.from_pydict({"id": pa.array([k for k, _ in rows], pa.int64()), "text": [t for _, t in rows]})]))
    given = pa.RecordBatch.from_arrays([batch.column(0), batch.column(0), batch.column(1)], ["id", "component", "long"])
    length, keys = neardup.split_keys(n, 80)
    split = pa.Table.from_batches(neardup._split(iter([given]), length, keys)).to_pandas()
    assert len(split) == n * keys
    groups = split.groupby("key").id.apply(list)
    met = {(max(a, b), min(a, b)) for g in groups if len(g) > 1 for a, b in itertools.combinations(g, 2)}
    assert want <= met and len(met - want) < 20 * n
    links = {(r.a, r.b) for r in neardup._links(described_sets(spark, docs_), docs_, 80).collect()}
    reach = {r.node: r.component for r in components.components(frame(spark, sorted(links), "a long, b long")).collect()}
    assert links <= want and all(reach[a] == reach[b] for a, b in want)


def described_sets(spark, texts):
    rows = texts.mapInArrow(neardup._describe, "doc_id long, n_shingles long, digest binary, u array<long>, v array<long>, sig binary")
    # One key for all: each first and second key is the same.
    one = F.transform("u", lambda _: F.lit(1).cast("long"))
    return rows.select(F.col("doc_id").alias("id"), "digest", one.alias("u"), one.alias("v"), "sig")


def test_near_duplicates_edges(spark, odd):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert [by[k][0].n_shingles for k in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert by[6][0].component_id == 5 and all(r.kept for r in by[5]) and len(by[5]) == 3
    assert by[None][0].component_id is None and by[None][0].kept
    assert neardup.near_duplicates(odd.limit(0)).count() == 0
    # Two texts of one id link what is like either.
    a, b = "a b c d e f g h", "q w e r t y u i"
    got = neardup.near_duplicates(frame(spark, [(1, a), (2, a), (2, b), (3, b)], "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {1}


def test_components(spark):
    rnd = random.Random(2)
    for links in ([(k, k + 1) for k in range(40)], [(rnd.randrange(60), rnd.randrange(60)) for _ in range(50)], [(5, 5)]):
        got = {r.node: r.component for r in components.components(frame(spark, links, "a long, b long")).collect()}
        parent = {}
        for a, b in links:
            for x in (a, b):
                parent.setdefault(x, x)
        changed = True
        while changed:
            changed = False
            for a, b in links:
                low = min(parent[a], parent[b])
                if parent[a] != low or parent[b] != low:
                    parent[a] = parent[b] = low
                    changed = True
        assert got == {k: v for k, v in parent.items() if any(k in p and p[0] != p[1] for p in links)}


# 5 WARC


def test_warc_round_trip(spark):
    long = "<p>" + "y" * 1500 + "</p>"
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (3, None, long), (4, "http://a/4\r\nX: y", ""), (5, "u", None), (6, "u", "short"), (7, "u", "short"), (None, "u", long), (3, "u", long), (8, "é", "é" * 999 + "\r\n\r\nWARC/1.1\r\n")]
    pages = frame(spark, rows, "page_id long, url string, html string")
    got = warc.read_records(warc.write_archives(pages)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for p, _, h in rows:
        data = (h or "").encode()
        revisit = h == long and p != 3
        want[p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, None if revisit else data] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_warc_pointers_resolve(spark):
    """Ids are unique, each revisit refers to a response of its payload, and the archives are gzip members with whole records."""
    long = "<p>" + "z" * 3000 + "</p>"
    rows = [(k, f"http://a/{k}", long if k % 3 else f"{k} " + long) for k in range(90)] + [(89, "http://b/89", long)] * 3 + [(None, "n", long)]
    index = warc.write_archives(frame(spark, rows, "page_id long, url string, html string").repartition(5))
    got = warc.read_records(index).collect()
    by_id = {r.record_id: r for r in got}
    assert len(by_id) == len(got) == len(rows)
    revisits = [r for r in got if r.record_type == "revisit"]
    assert len(revisits) == 60 and all(r.page_id != 89 for r in revisits)
    for r in revisits:
        target = by_id[r.refers_to_record]
        assert target.record_type == "response" and target.page_id == r.refers_to == 89 and target.payload_digest == r.payload_digest and target.payload_bytes == r.payload_bytes == len(long)
    for archive in {r.archive for r in index.collect()}:
        system, path = warc.opened(archive)
        data, members = system.open_input_file(path).read(), []
        while data:
            unpack = zlib.decompressobj(wbits=31)
            members.append(unpack.decompress(data) + unpack.flush())
            data = unpack.unused_data
        for m in members:
            head, _, rest = m.partition(b"\r\n\r\n")
            length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length:] == b"\r\n\r\n" and rest.startswith(b"HTTP/1.1 200 OK\r\n")


def test_warc_is_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_TASK", 2000)
    monkeypatch.setattr(warc, "FEW", 0)
    rnd = random.Random(1)
    rows = [(k, "u", "".join(rnd.choices("abcdef", k=1200)) if k % 2 else "same " * 300) for k in range(60)]
    data = frame(spark, rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("archive", F.lit(1)).withColumn("size", F.lit(2)).withColumn("page", F.lit(3))
    got = warc.read_records(warc.write_archives(data), payloads=False)
    assert "payload" not in got.columns and got.rdd.getNumPartitions() > 5
    assert Counter(r.record_type for r in got.collect()) == {"response": 31, "revisit": 29}


def test_warc_reads_selected_ranges_only(spark):
    pages = frame(spark, [(k, f"u{k}", f"page {k}") for k in range(50)], "page_id long, url string, html string")
    index = warc.write_archives(pages)
    assert sorted(r.page_id for r in warc.read_records(index.filter("page_id % 7 = 0")).collect()) == list(range(0, 50, 7))


# 6 HTML


def test_main_text(spark):
    page = '<html><head><title>T</title></head><body><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad">Buy <b>now</b>!</div><article><h1>Head &amp; more</h1><p>One\n two<br>three &lt;x&gt;.<p>Short.<script>var a = "</p><p>no";</script></article><footer>&copy; me</footer></body></html>'
    weights = maintext.train()
    assert maintext.main_text(page, weights) == "Head & more\nOne two three <x>.\nShort."
    got = maintext.extract_main_text(frame(spark, [(1, "u", page), (2, None, None), (None, "u", ""), (1, "u", page)], "page_id long, url string, html string")).collect()
    assert [(r.page_id, len(r.text), r.n_chars) for r in got] == [(1, 37, 37), (2, 0, 0), (None, 0, 0), (1, 37, 37)]


def test_labelled_pages_are_learnt():
    weights = maintext.train()
    for page in maintext.labelled_pages():
        assert maintext.main_text(page, weights) == "\n".join(b.text for b in maintext.blocks_of(page) if b.keep)


def test_cut_is_minimal():
    rnd = random.Random(4)
    for _ in range(200):
        n = rnd.randint(1, 7)
        source, sink = [[rnd.choice((0, 0.5, 1, 3)) for _ in range(n)] for _ in range(2)]
        edges = [(a, b, rnd.choice((0.2, 0.4, 1.0))) for a in range(n) for b in range(a) if rnd.random() < 0.5]

        def cost(side):
            return sum((sink if s else source)[k] for k, s in enumerate(side)) + sum(c for a, b, c in edges if side[a] != side[b])  # noqa: B023

        best = min(cost(x) for x in itertools.product((False, True), repeat=n))
        for cut in (maintext.source_side, maintext.separate):
            assert cost(cut(n, source, sink, edges)) == pytest.approx(best)


class PlainWalker(HTMLParser):
    """Texts between the bounds of elements that are not inline."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.now, self.off, self.head = [], "", 0, False

    def end(self):
        if text := " ".join(self.now.split()):
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title", "iframe", "svg", "template"):
            self.off += 1
        elif tag == "head":
            self.head = True
        elif not self.off:
            self.head = self.head and tag in maintext.VOID
            self.now += " " * (tag == "br")
            if tag not in maintext.INLINE and tag != "br":
                self.end()

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title", "iframe", "svg", "template"):
            self.off -= 1
        elif tag == "head":
            self.head = False
        elif not self.off and (tag not in maintext.INLINE or tag == "p"):
            self.end()

    def handle_data(self, data):
        if not self.off and not self.head:
            self.now += data


def test_blocks_are_those_of_a_plain_walker(sf_dir):
    for page in pd.read_parquet(f"{sf_dir}/pages.parquet").html:
        walker = PlainWalker()
        walker.feed(page)
        walker.close()
        walker.end()
        assert [b.text for b in maintext.blocks_of(page)] == walker.blocks


@pytest.mark.parametrize("page", ["<", "<p", "<" * 2000, '<a "' * 2000, "<div>" * 3000 + "x", "</p>" * 100, "<!-- ", "<script>", "<li>a<li>b", "&#x41;&bogus;", "<p>" + "x " * 50_000, "<!-->", "<!--->x", "</", "<a b=", "<a b='", "<svg/>", "<b>" * 5000 + "<h1>x" * 5000, '<a b=">" c=' * 5000, "<iframe>" * 5000])
def test_odd_pages(page):
    start = time.process_time()
    assert isinstance(maintext.main_text(page, maintext.train(rounds=20)), str)
    assert time.process_time() - start < 5


SAID = "The council met on Tuesday and agreed to a plan for the river, which had been under discussion for years."


@pytest.mark.parametrize("depth", [300, 5000, 100_000])
def test_nesting_has_no_limit(depth):
    weights = maintext.train()
    page = f"<body><nav>{'<div>' * depth}<a href=x>Home</a></nav><article><p>{SAID}</p></article></body>"
    assert maintext.main_text(page, weights) == SAID
    page = f"<body><nav><a href=x>Home</a></nav><article>{'<div>' * depth}<p>{SAID}</p></article><footer>(c) me</footer></body>"
    assert maintext.main_text(page, weights) == SAID


@pytest.mark.parametrize("attribute", ["data-x='" + "<p>a > b</p>" * 90_000 + "'", 'alt="a > b"', "title=it's", "data-x=a>", "x = '>' y"])
def test_attributes_of_any_length(attribute):
    page = f"<body><article><p {attribute if attribute[-1] != '>' else attribute[:-1]}>{SAID}</p></article></body>"
    assert maintext.main_text(page, maintext.train()) == SAID


@pytest.mark.parametrize("tag", ["svg", "select", "math", "object", "iframe", "noscript", "template", "textarea", "title"])
def test_unclosed_elements_do_not_take_the_page(tag):
    page = f"<body><article><p>{SAID} <{tag}></p><p>{SAID}</p></article><footer>(c) me</footer></body>"
    assert maintext.main_text(page, maintext.train()) == SAID + "\n" + SAID


@pytest.mark.parametrize("tag", ["math", "object", "noscript", "textarea"])
def test_only_what_is_no_text_is_dropped(tag):
    page = f"<body><article><p>{SAID} <{tag}>seven</{tag}></p></article></body>"
    assert maintext.main_text(page, maintext.train()) == SAID + " seven"


def test_a_page_of_many_blocks():
    rnd = random.Random(2)
    weights = maintext.train()
    start = time.process_time()
    items = "".join(f"<li>{'word ' * rnd.randint(1, 40)}{'.' * rnd.randint(0, 1)}</li>" for _ in range(60_000))
    page = f"<body><nav><a href=x>Home</a></nav><article>{f'<p>{SAID}</p>' * 40_000}</article><div class=sidebar><ul>{items}</ul></div></body>"
    text = maintext.main_text(page, weights)
    assert text.count(SAID) == 40_000 and time.process_time() - start < 30


def test_main_text_edges(spark):
    rows = frame(spark, [(1, "u", None), (None, None, "<p>x"), (2, "v", "")], "page_id long, url string, html string")
    for name in ("text", "n_chars", "html_", "id"):
        rows = rows.withColumn(name, F.lit("clash"))
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in maintext.extract_main_text(rows).collect()) == [(0, "", len(maintext.main_text("<p>x", maintext.train()))), (1, "u", 0), (2, "v", 0)]
    assert maintext.extract_main_text(rows.limit(0)).count() == 0


# 7 Nearest neighbours


def plain_nearest(rows, k):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in ok:
        if q % 20 == 0:
            out[q] = sorted(((-float(ok[q] @ v), i) for i, v in ok.items() if i != q))[:k]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x[300:500] = x[299]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] * 24), (None, [1.0] * 24)]
    data = frame(spark, rows, "vec_id long, embedding array<float>").withColumn("list", F.lit("clash"))
    want = plain_nearest(rows, 20)
    got = defaultdict(list)
    for r in ann.nearest(data, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    assert set(got) == set(want) and all([r["rank"] for r in v] == list(range(1, 21)) for v in got.values())
    hits = sum(len({r.vec_id for r in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    for q, v in got.items():
        for r in v:
            assert r.score == pytest.approx(float(x[q].astype(float) @ x[r.vec_id].astype(float)), abs=1e-9)
        assert [(-r.score, r.vec_id) for r in v] == sorted((-r.score, r.vec_id) for r in v)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_in_many_parts_and_two_levels(spark, monkeypatch, kind):
    """Small blocks, few centroids and small lists: several groups a list, a second level, and queries that go on."""
    for name, value in (("BLOCK", 64 * 16), ("CENTROIDS", 8), ("LIST_ROWS", 20), ("TRIED", 40)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((40, 16))[rng.integers(0, 40, 3000)] + 0.3 * rng.standard_normal((3000, 16))) * rng.uniform(0.5, 2, (3000, 1))
    x = x.astype(np.float32) if kind == "float" else x
    x[1000:1700] = x[1000]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    data = frame(spark, rows, f"vec_id long, embedding array<{kind}>")
    for name in ("id", "raw", "block", "part", "lists", "floor", "vector"):
        data = data.withColumn(name, F.lit("clash"))
    index = ann.fit(data.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), 20)
    assert len(index.lower) > 1 and index.probes > 1 and index.kind == (np.float32 if kind == "float" else np.float64)
    want, got = plain_nearest(rows, 20), defaultdict(list)
    for r in ann.nearest(data, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    assert all([r["rank"] for r in got[q]] == list(range(1, 21)) for q in want)
    assert sum(len({r.vec_id for r in got[q]} & {i for _, i in want[q]}) for q in want) >= 0.95 * 20 * len(want)
    for q in want:
        for r in got[q]:
            assert r.score == pytest.approx(float(x[q].astype(float) @ x[r.vec_id].astype(float)), abs=1e-12)


def test_nearest_goes_on_where_lists_are_small(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_ROWS", 3)
    monkeypatch.setattr(ann, "RECALL", 0.0)
    rng = np.random.default_rng(4)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.standard_normal((600, 8)).astype(np.float32))]
    got = Counter(r.query_id for r in ann.nearest(frame(spark, rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).collect())
    assert got == dict.fromkeys(range(0, 600, 20), 20)


def test_nearest_keeps_doubles(spark):
    x = [(0, [0.1, 1 / 3]), (1, [0.2, 0.4 + 1e-9]), (2, [1 / 7, 1 / 9])]
    got = ann.nearest(frame(spark, x, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, pytest.approx(0.1 * v[0] + v[1] / 3, abs=1e-16)) for i, v in x[1:]]


def test_nearest_with_few_rows(spark):
    data = frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0]), (3, [1.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in ann.nearest(data, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 3, 1.0), (0, 3, 2, 0.5)]
    assert ann.nearest(data.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(data.limit(1), F.col("vec_id") % 20 == 0).count() == 0


# 8 Language ID


def plain_viterbi(scores, switch):
    best, back = scores[0].astype(float), []
    for s in scores[1:]:
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back.append(np.where(stay, np.arange(len(s)), top))
        best = np.where(stay, best, best[top] - switch) + s
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi_over_rows():
    rng = np.random.default_rng(0)
    lengths = [0, 5, 1, 30, 0, 12]
    rows = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.uniform(-4, 0, (rows[-1], 4)).astype(np.float32)
    got = langid.viterbi(scores, rows, 3.0)
    for k, n in enumerate(lengths):
        if n:
            assert got[rows[k] : rows[k + 1]].tolist() == plain_viterbi(scores[rows[k] : rows[k + 1]], 3.0)


def test_viterbi_with_many_languages_and_a_long_text():
    rng = np.random.default_rng(1)
    for n_lang, lengths in ((200, [40, 0, 7, 300]), (200, [3] * 500 + [60]), (4, [1_000_000, 3]), (3, [5] * 100 + [2000, 17])):
        rows = np.concatenate([[0], np.cumsum(lengths)])
        scores = rng.uniform(-4, 0, (rows[-1], n_lang)).astype(np.float32)
        got = langid.viterbi(scores, rows, 2.0)
        for k in (0, len(lengths) - 2, len(lengths) - 1):
            if 0 < lengths[k] <= 3000:
                assert got[rows[k] : rows[k + 1]].tolist() == plain_viterbi(scores[rows[k] : rows[k + 1]], 2.0)
        assert got.min() >= 0 and got.max() < n_lang


def test_two_hundred_languages(spark):
    rnd = random.Random(4)
    words = [["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for _ in range(200)]
    rows = [(k, " ".join(rnd.choices(words[k % 200], k=30)), f"l{k % 200:03}") for k in range(1000)]
    df = frame(spark, rows, "doc_id long, text string, lang string")
    got = langid.predict(df, langid.fit(df)).collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 200:03}" for r in got) >= 990 and all(s.lang.startswith("l") for r in got for s in r.spans)


def plain_scores(model, word):
    """Log likelihoods of a word, n-gram by n-gram, by language, and how many n-grams it has."""
    total, count, points = [0.0] * len(model.languages), 0, [32, *map(ord, word.lower()), 32]
    for n in langid.ORDERS:
        for k in range(len(points) - n + 1):
            h = (points[k] * int(langid.BASE) + 1) % 2**64
            for p in points[k + 1 : k + n]:
                h = (h * int(langid.BASE) + p + 1) % 2**64
            h = (h + n) % 2**64
            for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D), (33, 1)):
                h = (h ^ h >> shift) * factor % 2**64
            count += 1
            total = [t + float(x) for t, x in zip(total, model.table[h >> 64 - langid.BITS], strict=True)]
    return total, count


def test_scores_are_those_of_the_ngrams(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(df)
    text = "The old house, straße FENÊTRE niño a the THE \u03b1\u03b2 x1y"
    for _, _, cp, script, starts, ends, _, _ in langid.words_of(pa.array([text])):
        capped, whole, count = model.scores(cp, script, starts, ends)
        words = ["".join(map(chr, cp[s:e])) for s, e in zip(starts, ends, strict=True)]
        assert words[0] == "the" and words[-1] == "y"
        for k, word in enumerate(words):
            want, n = plain_scores(model, word)
            assert count[k] == n and whole[k].tolist() == pytest.approx(want, rel=1e-4)
            allowed = model.allowed[script[starts[k]]]
            if allowed.any():
                part = np.where(allowed, np.array(want) / n**0.5, -np.inf)
                assert capped[k].tolist() == pytest.approx(np.maximum(part - part.max(), -langid.WORD_CAP).tolist(), abs=1e-3)
            else:
                assert not capped[k].any()


def test_language(spark, sf_dir, odd):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    got = langid.identify_languages(df, held).join(df.select("doc_id", F.col("lang").alias("true")), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.true for r in out) >= 0.95 * len(out) and all(0 <= r.score <= 1 for r in got)
    model = langid.fit(df)
    edge = langid.predict(odd, model).collect()
    assert len(edge) == odd.count()
    by = {r.doc_id: r for r in edge}
    assert [by[k].lang_pred for k in (0, 1, 2, 11)] == ["und"] * 4 and by[9].lang_pred != "und"
    assert langid.predict(odd.limit(0), model).count() == 0
    assert langid.fit(df.limit(0)) is None and {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}


def test_mixed_text_has_spans(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(df)
    en, fr = (df.filter((F.col("lang") == x) & (F.col("n_chars") > 600)).orderBy("doc_id").first().text[:500] for x in ("en", "fr"))
    spans = langid.predict(frame(spark, [(1, en + " " + fr)], "doc_id long, text string"), model).first().spans
    assert [s.lang for s in spans] == ["en", "fr"] and abs(spans[1].start - 501) < 60


# 9 Pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_without_dropout_it_is_the_library(vocabulary, sf_dir):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(vocabulary, dropout=0.0)
    texts = pd.read_parquet(f"{sf_dir}/documents.parquet").text.tolist()[:60] + ["a  b   c \n\n x", "\ttab\r\n", "日本語 \U0001f389", "q" * 300]
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode_many(texts, [0] * len(texts))] == [library.encode(t) for t in texts]


def test_dropout_varies_and_decodes(vocabulary):
    encoder = pieces.Encoder(vocabulary, dropout=0.3)
    text = "the quick brown fox ▁ jumps \n over\t" * 5
    found = {encoder.encode(text, k) for k in range(20)}
    assert len(found) > 10
    assert {pieces.decoded(vocabulary, np.frombuffer(x, np.int32).tolist()) for x in found} == {text}
    assert encoder.encode(text, 3) == pieces.Encoder(vocabulary, dropout=0.3).encode(text, 3)
    assert encoder.encode(text, 3) != pieces.Encoder(vocabulary, dropout=0.3, seed=2).encode(text, 3)


def test_agendas_agree(vocabulary):
    encoder = pieces.Encoder(vocabulary, dropout=0.2)
    rnd = random.Random(6)
    units = [" " * rnd.randint(0, 2) + "".join(rnd.choice("theandisonerti") for _ in range(rnd.randint(1, 20))) for _ in range(500)]
    variants = [rnd.randrange(encoder.variants) for _ in units]
    assert encoder._many(units, variants) == [encoder._unit(u, v) for u, v in zip(units, variants, strict=True)]
    for u in units:
        assert encoder._short(u, 17) == encoder._long(u, 17)


def test_each_occurrence_has_drops_of_its_own(vocabulary):
    encoder = pieces.Encoder(vocabulary, dropout=0.1)
    n, found = 3000, Counter()
    for document in range(2):
        part = []
        for k in np.frombuffer(encoder.encode("language " * n, document), np.int32).tolist():
            part.append(k)
            if b"".join(vocabulary.pieces[k] for k in part) == b" language":
                found[tuple(part)] += 1
                part = []
    assert sum(found.values()) == 2 * n and len(found) > 10
    drops = encoder._drops(np.full(n, 13), np.full(n, 7), np.arange(n))[0]
    assert [((drops >> k) & 1).mean() for k in range(63)] == pytest.approx([0.1] * 63, abs=0.025)
    # What is kept is what the drops of an occurrence give, short or long, at any time.
    rnd = random.Random(5)
    for _ in range(3):
        texts = ["".join(rnd.choice(("the ", "under", "standing ", "é\U0001f600 ", "▁", "  \n", "q" * 30)) for _ in range(300)) for _ in range(20)]
        fresh = [pieces.Encoder(vocabulary, dropout=0.1) if k % 10 == 0 else None for k in range(20)]
        got = encoder.encode_many(texts, list(range(20)))
        assert all(f is None or f.encode(t, k) == x for k, (f, t, x) in enumerate(zip(fresh, texts, got, strict=True)))
        for k, (t, x) in enumerate(zip(texts, got, strict=True)):
            units = pieces._UNITS.findall(" " + t)
            drops, key = encoder._drops(np.array([len(u) for u in units], np.int64), np.full(len(units), k), np.arange(len(units)))
            drops = drops.tolist()
            assert x == b"".join(encoder._unit(u, d) if len(u) <= pieces.SHORT else encoder._long_unit(u, int(h)) for u, d, h in zip(units, drops, key, strict=True))


def test_kept_segmentations_change_nothing(vocabulary, monkeypatch):
    rnd = random.Random(12)
    texts = [" ".join("".join(rnd.choices("aeinrst", k=rnd.randint(1, 9))) for _ in range(400)) for _ in range(12)]
    whole = pieces.Encoder(vocabulary).encode_many(texts, list(range(12)))
    monkeypatch.setattr(pieces, "KEPT", 500)
    encoder = pieces.Encoder(vocabulary)
    for _ in range(2):
        assert [encoder.encode(t, k) for k, t in enumerate(texts)] == whole
        assert encoder.full and encoder.size == len(encoder.units) <= encoder.full[0] and set(encoder.roots.values()) <= set(range(encoder.size))
    assert len(encoder.encode("x", -(2**62))) > 0


def test_segmentations_of_one_word_have_their_shares(vocabulary):
    """Over 2,000 documents, one word has each segmentation as often as drops of 0.1 a candidate give it."""
    encoder, rnd, n = pieces.Encoder(vocabulary), random.Random(3), 2000
    got = Counter(encoder.encode_many(["understanding"] * n, list(range(n))))
    want = Counter(encoder._unit(" understanding", sum((rnd.random() < 0.1) << k for k in range(39))) for _ in range(20 * n))
    assert len(got) > 20
    for x, m in want.most_common(8):
        assert got[x] / n == pytest.approx(m / (20 * n), abs=0.035)


def test_long_texts_by_parts_have_the_ids_of_the_whole(vocabulary, monkeypatch):
    rnd = random.Random(13)
    words = ["the", "water", "été", "日本語", "\n", "  ", "\u2581", "x" * 300, "\U0001f600", "international"]
    texts = [sep.join(rnd.choices(words, k=200)) for sep in (" ", "", "\n")] + ["y" * 2000, " ", "\n"]
    whole = [pieces.Encoder(vocabulary, dropout=0.2).encode(t, k) for k, t in enumerate(texts)]
    monkeypatch.setattr(pieces, "TOGETHER", 0)
    monkeypatch.setattr(pieces, "PART", 7)
    assert [pieces.Encoder(vocabulary, dropout=0.2).encode(t, k) for k, t in enumerate(texts)] == whole
    for text, ids in zip(texts, whole, strict=True):
        assert pieces.restores(vocabulary.pieces, ids, text) and pieces.decoded(vocabulary, np.frombuffer(ids, np.int32).tolist()) == text
        assert not pieces.restores(vocabulary.pieces, ids, text + "a") and not pieces.restores(vocabulary.pieces, ids[:-4], text) and not pieces.restores(vocabulary.pieces, ids, text[:-1])


def test_pieces_table(spark, odd):
    got = pieces.encode_documents(odd)
    assert sorted(got.columns) == sorted({*odd.columns, "n_pieces", "lossless"})
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.lossless and len(r.ids) == r.n_pieces for r in rows)
    back = pieces.decode_documents(got.select("doc_id", "ids", F.col("text").alias("was")))
    assert all(r.text == (r.was or "") for r in back.collect())
    assert pieces.encode_documents(odd.limit(0)).count() == 0


# 10 Fingerprints


def test_fingerprints(spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(("alpha", "beta", "gamma", "delta", "ünï")) for _ in range(rnd.randint(0, 80))) for _ in range(60)] + [None, "", "one", "one"]
    ids = rnd.sample(range(10_000), len(texts))
    df = frame(spark, list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in fingerprint.fingerprint_documents(df).collect()}
    order = sorted(zip(ids, (t or "" for t in texts), strict=True))
    prints = defaultdict(set)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        prints[t].add(got[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and prints[""] == {""}


def plain_fingerprint(text):
    """(words, digest, kept) by a library's XXH64, whose seed is the hash of what came before."""
    top = 2**63 - 1

    def chain(values, seed=42):
        for v in values:
            seed = xxhash.xxh64_intdigest((v % 2**64).to_bytes(8, "little"), seed)
        return seed

    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text)]
    found = {chain(words[k : k + 5]) & top for k in range(max(1, len(words) - 4))} if words else set()
    return len(words), chain(words), {h for h in found if h < top // fingerprint.SCALE}


def plain_alike(a, b):
    if a[:2] == b[:2]:
        return 1.0
    return len(a[2] & b[2]) / len(a[2] | b[2]) if a[2] | b[2] else 0.0


def test_fingerprints_are_those_of_a_plain_version(spark):
    rnd = random.Random(18)
    words = ["alpha", "beta", "gamma", "delta", "ünï", "\U0001f600"]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 120))) for _ in range(80)] + [None, "", "one", "one two", "one"]
    ids = [None if k == 7 else k % 60 for k in range(len(texts))]
    got = fingerprint.fingerprint_documents(frame(spark, list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)).collect()
    rows = sorted((i is not None, i or 0, (h := xxhash.xxh64_intdigest((t or "").encode(), xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42))) - 2**64 * (h >> 63), t or "") for i, t in zip(ids, texts, strict=True))
    want = Counter()
    for (known, i, _, t), (*_, following) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        own, other, after = (plain_fingerprint(x) for x in (t, edited, following))
        text = lambda f: "" if not f[0] else f"{f[0]}:{f[1]:x}:" + ",".join(f"{h:x}" for h in sorted(f[2]))
        want[i if known else None, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(own), text(other), round(plain_alike(own, other), 12), round(plain_alike(own, after), 12)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12)) for r in got) == want


def test_rows_of_one_id_are_in_several_ranges(spark):
    df = frame(spark, [(5, f"text {k}") for k in range(400)], "doc_id long, text string")
    paired = fingerprint.with_next(df, ["text"], slices=16)
    assert len({r.text for r in paired.collect()}) == 400 == len({r["next"].text for r in paired.collect()})


def test_fingerprint_edges(spark, odd):
    got = fingerprint.fingerprint_documents(odd).collect()
    assert len(got) == odd.count()
    assert fingerprint.fingerprint_documents(odd.limit(0)).count() == 0
    (only,) = fingerprint.fingerprint_documents(frame(spark, [(1, "abcd")], "doc_id long, text string")).collect()
    assert only.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_sketches_merge_and_estimate(spark):
    rnd = random.Random(9)
    words = [str(rnd.randrange(10**6)) for _ in range(4000)]
    a, b = " ".join(words[:3000]), " ".join(words[2000:])
    both = a + " " + " ".join(f"x{k}" for k in range(5))
    row = frame(spark, [(a, b, " ".join(words[:400]), "one", both)], "a string, b string, c string, d string, e string").select(*[fingerprint.sketch(F.col(x)).alias(x) for x in "abcde"])
    est = row.select(fingerprint.likeness(F.col("a"), F.col("b")).alias("j"), fingerprint.containment(F.col("c"), F.col("a")).alias("c"), F.size(fingerprint.merged(F.col("a"), F.col("b"))).alias("m"), F.size(F.array_union("a", "b")).alias("u"), F.size("a").alias("n"), fingerprint.containment(F.col("a"), F.col("e")).alias("s")).first()
    assert est.j == pytest.approx(0.25, abs=0.06) and est.c == 1.0 == est.s and est.m == est.u
    assert est.n == pytest.approx(2996 / fingerprint.SCALE, rel=0.2)
