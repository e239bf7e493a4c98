"""Personal data in texts: base patterns, and a linear-chain conditional random field over word shapes.

The base spans are what four patterns and their checks find. The field is trained on a small labelled
table and labels words as begin or inside of a kind, decoded by Viterbi for all word runs of a batch
together. Its spans that no base span overlaps, and that pass their kind's own check, are added.

In the model a word with a letter and without digit or at sign is outside of all kinds, as no kind's form has such words; training
and decoding go over the runs of the other words, each run between two words that are outside, which gives the same labels as going over all words.
The words around a run are seen by all its words: themselves, their beginnings, endings and marks, so the same number is a phone number
after one word and the number of an order after another.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import small_batches
from tessera.llm.textops import utf8

KINDS = ("email", "ip", "card", "phone")
STATES = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

#: A small labelled table: one line of words each, personal data in marks.
LABELLED = """\
write to <email>anna.maria@mail.example.org</email> or come by
mail <email>j_doe+news@sub-domain.example.co.uk</email>, thanks
contact: <email>info@example.com</email>.
his address <email>x99%y@a.example.net</email> bounced
(<email>support.team@host1.example.io</email>)
follow us @example and @other today
price is 5 @ 3 each
a@b is no address
server <ip>10.0.0.1</ip> answered
from <ip>192.168.17.254</ip> to <ip>8.8.4.4</ip>
the host <ip>172.16.254.3</ip>, was down
(<ip>203.0.113.77</ip>)
version 1.2.3 was released
see section 4.5.6.7.8 of the manual
build 999.888.777.666 failed
on 12.05.2021 at 10.30
card <card>4111111111111111</card> was charged
paid by <card>5500005555555559</card>.
number <card>4012 8888 8888 1881</card> please
number <card>3782-822463-10005</card> please
use <card>6011-1111-1111-1117</card>, thanks
my card <card>3530 1113 3330 0000</card> expired
<card>4222222222222</card> is short
order 4111111111111112 was shipped
serial 1234567890123456 is not valid
item 7000000000000001 sold out
call <phone>+1 (212) 555-0187</phone> now
phone <phone>+49 30 5550 1234</phone>.
reach me at <phone>+44-20-7946-0958</phone> today
tel <phone>+33 1 55 50 12 34</phone>, mornings
<phone>(415) 555-2671</phone> is my number
ring <phone>(030) 555-01234</phone> after five
dial <phone>212-555-0187</phone> please
dial <phone>646-555-9310</phone>.
or <phone>(917) 555-4821</phone>, evenings
fax <phone>303-555-7742</phone> or mail
phone <phone>(503) 555-1109</phone> for help
call <phone>415 555 2671</phone> after noon
mobile <phone>0171 5550123</phone>, please
<phone>020 7946 0958</phone> is the office
tel <phone>0151 23456789</phone> or mail
my number: <phone>646 555 0199</phone>.
reach us on <phone>089 5550143</phone> or by mail
in 1999 and 2024 we met
of 1500 rows 250 are new
rows 100 200 300 of the table
from 2001 2005 2010 on
sizes 640 480 and 1024 768 are known
weights 12 345 678 in grams
population 3 645 000 in 2011
lines 120 4500 70 were cut
0171 is a code and 0049 too
it cost 1,299.00 or 15% less
pages 12-15 and 100-250
room 555 on floor 3
the 3 of 12 items, 45678 in all
key = "0123456789abcdef0123456789abcdef01234567"
token 9f86d081884c7d659a2feaa0c55ad015 expired
hash 24be64439e3e49cf46b2d7c90f3602a3d0b907ff here
at 10:45 on 2021-05-12
date 2020-01-31 00:00:00 logged
call 12 or 13 of them
id 555123 and code 9981
add +1 to 22 and +3 more
in 10 20 30 40 50 steps
licensed under version 3 of 2007
scores 3-2 and 10-7
1234 5678 lines
chapter 12 (page 345) again
(2019) and (2020) editions
"""

#: Frames for the numbers below: of phone numbers, of other numbers of the same form, and words that tell nothing.
PHONE_FRAMES = """\
call {} now
please call us at {} today
phone {} or write
phone: {}
telephone {} for details
tel. {}
tel: {}, mornings
Tel.: {} (office)
fax {} only
fax: {}
mobile {} after six
cell: {}
my mobile number is {} since then
my number is {}
ring {} in the evening
ring me on {} before noon
dial {} to reach us
reach me at {} at night
contact us under {} or by mail
text {} for help
hotline {} is free
Telefon {} erreichbar
Tel {} und Fax
Handy: {}
Mobil {} bitte anrufen
Rufnummer {} lautet so
rufen Sie {} an
téléphone {} le matin
appelez le {} avant midi
portable : {} ou bureau
teléfono {} por la tarde
llame al {} hoy
móvil: {} gracias
WhatsApp {} any time
office {} extension
"""
OTHER_FRAMES = """\
order {} shipped
the order {} was late
order no. {} is open
order number {} arrived
orders {} and more
serial {} part
serial number {} is on the back
serial no {} of the unit
sum {} total
a sum of {} in all
total {} units
the total is {} so far
rows {} found
lines {} were cut
records {} of the table
invoice {} is due
invoice no. {} was paid
account {} was closed
article {} sold out
item {} in stock
part {} is missing
ticket {} was closed
case {} before court
reference {} of the letter
ref. {} please
id {} not known
code {} is not valid
batch {} expired
model {} with cable
version {} of the file
population {} in all
ISBN {} hardcover
tracking {} delivered
parcel {} sent back
customer {} left
contract {} ended
Bestellung {} wurde versandt
Bestellnummer {} ist offen
Rechnung {} ist bezahlt
Summe {} gesamt
Seriennummer {} am Teil
Artikel {} ausverkauft
Kunde {} ging
commande {} est partie
facture {} payée
série {} de la pièce
somme {} en tout
pedido {} enviado
factura {} pagada
total {} filas
"""
PLAIN_FRAMES = "kitchen {} mirror|blue {} seems|also {} because|and {} then|summer {} forest|old {} friends|said {} again|they {} went|{} is here|maybe {}|rather {} quickly|of {} on|the {} it"
#: Phone numbers in forms that also occur as other numbers, and numbers that are of no phone's form.
PHONES = "212-555-0187|(415) 555-2671|(415)555-2671|646 555 0199|0171 5550123|030/5550123|030 / 5550123|020 7946 0958|0043 1 5550 1234|0049-30-5550123|303.555.7742|089 5550143|917-555-4821|0151/23456789|(030) 5550 1234|123 456 7890|0033 1 55 50 12 34|0221-5550178|503 555-1109"
OTHERS = "1999|250|12-15|12/05/2021|12.05.2021|2020/2021|2021-05-12|640 480|3 645 000|(2019)|555123|45678|98765432|100 200 300|345 678 912|1,299.00|48213 1500|71234 5678|10:45|3/4|12.50"

_SPACE = r"\x20\x09-\x0D"
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_HEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match never begins inside a run of digits that was already looked at, so runs are taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY_PHONE = re.compile(r"[+(]*[0-9][\x20()./0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"<(\w+)>(.*?)</\1>")
_ALL_WORDS = re.compile(rf"[^{_SPACE}]+")
#: Words with a digit or an at sign, and words that are only marks of phone numbers.
_LIVE_WORDS = re.compile(rf"(?<![^{_SPACE}])(?:[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+|[+()/-]++(?![^{_SPACE}]))")
#: Characters on both sides of a run in which its neighbours are looked for, and how many of them are seen.
REACH, BEFORE, AFTER = 64, 3, 2
_EDGES = ".,;:!?\"'#$%&*|()[]<>"
_RUNS = re.compile(r"[0-9]+|[A-Z]+|[^\W\d_A-Z]+|[^0-9A-Za-z]", re.ASCII)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def passes(kind: str, text: str) -> bool:
    """The check that a match of a kind must pass."""
    if kind == "email":
        return True
    if kind == "ip":
        return all(p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))
    digits = "".join(_DIGIT.findall(text))
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _EMAIL_HEAD:
            start -= 1
        found = _EMAIL_TAIL.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base matches, by start and kind."""
    found = [(s, 0, e) for s, e in emails(text)]
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if passes(KINDS[kind], m.group())]
    return sorted(found)


def _bucket(n: int) -> str:
    return str(n) if n < 5 else "5-6" if n < 7 else "7-8" if n < 9 else "9-11" if n < 12 else "12-19" if n < 20 else "20+"


def size_of(word: str) -> str:
    """What a word of a run shows the words beside it: about how many digits it has."""
    return _bucket(len(_DIGIT.findall(word)))


def around(text: str, start: int, end: int) -> tuple[str, ...]:
    """Features of the words around the run text[start:end]: words in lower case, their first and last letters, shape and mark of the nearest."""
    left, right = text[max(0, start - REACH) : start], text[end : end + REACH]
    before, after = _ALL_WORDS.findall(left), _ALL_WORDS.findall(right)
    if start > REACH and before and _ALL_WORDS.match(text[start - REACH - 1]) and _ALL_WORDS.match(left):
        del before[0]  # only its end is in reach
    if end + REACH < len(text) and after and _ALL_WORDS.match(text[end + REACH]) and _ALL_WORDS.match(right[-1]):
        del after[-1]
    out = []
    for side, words in (("before", before[::-1][:BEFORE]), ("after", after[:AFTER])):
        for k, word in enumerate(words):
            core = word.strip(_EDGES).lower()
            if _DIGIT.search(core):
                core = "9"
            out.append(f"{side}={core}")
            if len(core) > 3:
                out += [f"{side}={core[:3]}*", f"{side}=*{core[-3:]}"]
            if k == 0:
                out += [f"next {side}={core}", f"{side} shape={'X' if word.isupper() else 'Xx' if word[:1].isupper() else 'x'}"]
                if not word[-1].isalnum():
                    out.append(f"{side} mark={word[-1]}")
    return tuple(out)


def word_features(word: str, before: str = "", after: str = "") -> tuple[str, ...]:
    """Shape features of one word of a run, with the ``size_of`` the words beside it."""
    core = word.strip(".,;:!?\"'#$%&*|")
    digits = _DIGIT.findall(core)
    if not digits and "@" not in core:
        return ("bias", "marks", f"marks={core[:1]}", f"around={before},-,{after}")
    parts = core.split(".")
    own = _bucket(len(digits)) + ("+" if core[:1] == "+" else "(" if core[:1] == "(" else "0" if core[:1] == "0" else "")
    out = ["bias", "live", f"around={before},{own},{after}", f"before={before},{own}", f"after={own},{after}", f"digits={_bucket(len(digits))}", f"first={core[:1] if not core[:1].isalnum() else 'd' if core[:1].isdigit() else 'x'}"]
    marks = "".join(sorted({c for c in core if not c.isalnum()}))
    out += [f"marks={marks}", f"marks={marks},{_bucket(len(digits))}", "lead=" + ("00" if core[:2] == "00" else "0" if core[:1] == "0" else "x")]
    out.append("shape=" + "".join(p[0] if not p[0].isalnum() else ("d" * min(len(p), 4) if p[0].isdigit() else "x") for p in _RUNS.findall(core)))
    if any(c.isalpha() for c in core):
        out.append("letters")
    if "@" in core:
        out.append("address" if any(True for _ in emails(core)) else "at sign")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append("quad" if passes("ip", core) else "bad quad")
    if 12 <= len(digits) <= 19:
        out.append("luhn" if luhn("".join(digits)) else "no luhn")
    if core[:1] == "+":
        out.append(f"plus,{_bucket(len(digits))}")
    if core[:1] == "(" and core[-1:] == ")":
        out.append("in brackets")
    if core.count("-") == 2 and core.replace("-", "").isdigit():
        out.append("two dashes," + ",".join(_bucket(len(p)) for p in core.split("-")))
    return tuple(out)


def viterbi(emit: np.ndarray, rows: np.ndarray, trans: np.ndarray, edge: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Best states of all runs of words, which ``rows`` bounds; all runs step together. ``edge``: scores of a first and a last state."""
    length = np.diff(rows)
    order = np.argsort(-length, kind="stable")
    begin, length = rows[:-1][order], length[order]
    steps = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(steps), "left")
    origin = np.zeros(emit.shape, np.int8)
    best = np.zeros((len(order), emit.shape[1]))
    for t in range(steps):
        k = alive[t]
        at = begin[:k] + t
        if t:
            ways = best[:k, :, None] + trans[None]
            origin[at] = ways.argmax(1)
            best[:k] = ways.max(1) + emit[at]
        else:
            best[:k] = emit[at] + edge[0]
    state = (best + edge[1]).argmax(1)
    out = np.zeros(len(emit), np.int8)
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        out[at] = state[:k]
        if t:
            state[:k] = origin[at, state[:k]]
    return out


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, names: dict[str, int], weight: np.ndarray, trans: np.ndarray):
        self.names, self.weight, self.trans = names, weight, trans
        self._known: dict[tuple[str, str, str], np.ndarray] = {}

    def _sum(self, features: tuple[str, ...]) -> np.ndarray:
        return self.weight[[self.names[f] for f in features if f in self.names]].sum(0)

    def emission(self, word: str, before: str = "", after: str = "") -> np.ndarray:
        key = word, before, after
        found = self._known.get(key)
        if found is None:
            found = self._sum(word_features(*key))
            if len(self._known) < 100_000 and len(word) < 100:
                self._known[key] = found
        return found

    def emissions(self, words: list[str], context: tuple[str, ...]) -> list[np.ndarray]:
        """Of the words of a run."""
        sizes, near = ["", *map(size_of, words), ""], self._sum(context)
        return [self.emission(w, sizes[k], sizes[k + 2]) + near for k, w in enumerate(words)]


def runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of the words of each run: words that may be of a kind, without another word between them."""
    run: list[tuple[int, int]] = []
    for m in _LIVE_WORDS.finditer(text):
        if run and text[run[-1][1] : m.start()].strip(" \t\n\v\f\r"):
            yield run
            run = []
        run.append(m.span())
    if run:
        yield run


def labelled_table() -> list[str]:
    """The labelled lines: those written out, and each frame with some of the numbers, in turn."""
    phones, others = PHONES.split("|"), OTHERS.split("|")
    lines = LABELLED.splitlines()
    for frames, number, label in ((PHONE_FRAMES.splitlines(), phones, True), (OTHER_FRAMES.splitlines(), phones, False), (PHONE_FRAMES.splitlines(), others, False), (OTHER_FRAMES.splitlines(), others, False)):
        for k, frame in enumerate(frames):
            lines += [frame.format(f"<phone>{n}</phone>" if label else n) for j, n in enumerate(number) if (j + k) % (3 if number is phones else 7) == 0]
    for frame in PLAIN_FRAMES.split("|"):
        lines += [frame.format(f"<phone>{n}</phone>") for n in phones] + [frame.format(n) for n in others]
    return lines


def labelled_runs(line: str) -> Iterator[tuple[list[tuple[str, ...]], list[int]]]:
    """Features and states of the words of each run of a marked line."""
    marks, text, at = [], "", 0
    for m in _MARK.finditer(line):
        text += line[at : m.start()]
        marks.append((len(text), len(text) + len(m[2]), m[1]))
        text += m[2]
        at = m.end()
    text += line[at:]
    for run in runs(text):
        words, states = [text[s:e] for s, e in run], []
        for s, e in run:
            inside = next((x for x in marks if x[0] < e and s < x[1]), None)
            states.append(0 if inside is None else STATES.index(("B-" if s <= inside[0] else "I-") + inside[2]))
        sizes, context = ["", *map(size_of, words), ""], around(text, run[0][0], run[-1][1])
        yield [word_features(w, sizes[k], sizes[k + 2]) + context for k, w in enumerate(words)], states


def likelihood(weight: np.ndarray, trans: np.ndarray, data: tuple) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of labelled runs and its gradients; forward and backward sums go over all runs together.

    A run lies between two words that are outside: its first word is entered from state 0 and its last left for it.
    """
    feature, begin, y, real = data
    (n, steps), s = y.shape, len(STATES)
    score, rows, last = np.add.reduceat(weight[feature], begin), np.arange(n), real.sum(1) - 1
    top = score.max(1, keepdims=True)
    move, emit = np.exp(trans), np.zeros((n, steps, s))
    emit[real] = np.exp(score - top)
    ahead, back, scale = np.zeros((n, steps, s)), np.zeros((n, steps, s)), np.ones((n, steps))
    alive = [np.flatnonzero(real[:, t]) for t in range(steps)]
    for t, k in enumerate(alive):
        step = (ahead[k, t - 1] @ move if t else move[0]) * emit[k, t]
        scale[k, t] = step.sum(1)
        ahead[k, t] = step / scale[k, t, None]
    left = ahead[rows, last] @ move[:, 0]
    back[rows, last] = move[:, 0] / left[:, None]
    pair = np.zeros((s, s))
    for t in range(steps - 1, 0, -1):
        k = alive[t]
        later = emit[k, t] * back[k, t] / scale[k, t, None]
        pair += ahead[k, t - 1].T @ later * move
        back[k, t - 1] = later @ move.T
    node = ahead * back
    gold, both = y[real], real[:, 1:]
    wrong = np.eye(s)[gold] - node[real]
    long = np.diff([*begin, len(feature)])
    grad_w = np.stack([np.bincount(feature, np.repeat(wrong[:, k], long), len(weight)) for k in range(s)], 1)
    grad_t = -pair
    np.add.at(grad_t, (y[:, :-1][both], y[:, 1:][both]), 1)
    grad_t[0] += (np.eye(s)[y[:, 0]] - node[:, 0]).sum(0)
    grad_t[:, 0] += (np.eye(s)[y[rows, last]] - node[rows, last]).sum(0)
    path = score[np.arange(len(gold)), gold].sum() + trans[0, y[:, 0]].sum() + trans[y[rows, last], 0].sum() + trans[y[:, :-1][both], y[:, 1:][both]].sum()
    return float(path - np.log(scale).sum() - top.sum() - np.log(left).sum()), grad_w, grad_t


def training_data(lines: list[str]) -> tuple[dict[str, int], tuple]:
    """Numbers of the features, and what ``likelihood`` takes: features of all words, where each word's begin, states, and which steps are words."""
    found = [r for line in lines for r in labelled_runs(line)]
    names: dict[str, int] = {}
    feature, begin = [], []
    real = np.arange(max(len(y) for _, y in found)) < np.array([[len(y)] for _, y in found])
    y = np.zeros(real.shape, int)
    y[real] = list(itertools.chain(*(states for _, states in found)))
    for word in itertools.chain(*(words for words, _ in found)):
        begin.append(len(feature))
        feature += [names.setdefault(f, len(names)) for f in word]
    return names, (np.array(feature), np.array(begin), y, real)


def train(lines: list[str] | None = None, rounds: int = 250, rate: float = 0.3, decay: float = 0.02) -> Field:
    """Maximum likelihood with an L2 penalty, by AdaGrad. The labelled table is small by nature and is fitted where it is called."""
    names, data = training_data(labelled_table() if lines is None else lines)
    weight, trans = np.zeros((len(names), len(STATES))), np.zeros((len(STATES), len(STATES)))
    seen_w, seen_t = np.full_like(weight, 1e-8), np.full_like(trans, 1e-8)
    for _ in range(rounds):
        _, grad_w, grad_t = likelihood(weight, trans, data)
        grad_w -= decay * weight
        grad_t -= decay * trans
        seen_w += grad_w**2
        seen_t += grad_t**2
        weight += rate * grad_w / np.sqrt(seen_w)
        trans = trans + rate * grad_t / np.sqrt(seen_t)
    return Field(names, weight, trans)


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind number, end) of what the field labels in each text."""
    emit, rows, of, where = [], [0], [], []
    for k, text in enumerate(texts):
        for run in runs(text):
            emit += field.emissions([text[s:e] for s, e in run], around(text, run[0][0], run[-1][1]))
            rows.append(len(emit))
            of += [k] * len(run)
            where += run
    out: list[list] = [[] for _ in texts]
    if not emit:
        return out
    states = viterbi(np.array(emit), np.array(rows), field.trans, (field.trans[0], field.trans[:, 0]))
    begins = set(rows)
    at = 0
    while at < len(states):
        state, first = states[at], at
        at += 1
        if state == 0:
            continue
        kind = (state - 1) // 2
        while at < len(states) and at not in begins and states[at] == 2 * kind + 2:
            at += 1
        text, (start, end) = texts[of[first]], (where[first][0], where[at - 1][1])
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if start < end:
            out[of[first]].append((start, int(kind), end))
    return out


def find_all(field: Field, texts: list[str]) -> list[tuple[list, list]]:
    """Base spans and added spans of each text."""
    out = []
    for text, labelled in zip(texts, field_spans(field, texts), strict=True):
        base = base_spans(text)
        added, bound = [], sorted((s, e) for s, _, e in base)
        for s, kind, e in labelled:
            body = text[s:e]
            whole = [*emails(body)] == [(0, len(body))] if kind == 0 else bool((_IP, _CARD, _ANY_PHONE)[kind - 1].fullmatch(body))
            if whole and passes(KINDS[kind], body) and not any(a < e and s < b for a, b in bound):
                added.append((s, kind, e))
        out.append((base, added))
    return out


def _live_rows(column: pa.Array) -> np.ndarray:
    """Rows with a digit or an at sign; others hold nothing."""
    data, off = utf8(column)
    live = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
    return np.unique(np.searchsorted(off, live, "right") - 1)


def _joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


#: Texts of at most so many characters together are labelled at once.
_TOGETHER = 1 << 20


def _rounds(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    rows, texts, size = [], [], 0
    for k in _live_rows(column).tolist():
        text = column[k].as_py()
        rows.append(k)
        texts.append(text)
        size += len(text)
        if size > _TOGETHER:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def find_personal_data(docs: DataFrame, field: Field | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of each row.

    The counts and base_sha256 are of the base spans; ``spans`` lists base and added spans as kind:start:end by
    start, then kind in the order email, ip, card, phone, joined by commas; offsets are code points. A null text is
    empty: counts 0, empty spans. Rows of equal id stay apart; other columns are not looked at.
    """
    small_batches(docs)
    import hashlib

    field = field or train()
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((len(KINDS), n), np.int64)
            digest, spans, extra = [nothing] * n, [""] * n, np.zeros(n, np.int64)
            for rows, texts in _rounds(batch.column(1)):
                for k, (base, added) in zip(rows, find_all(field, texts), strict=True):
                    for _, kind, _ in base:
                        counts[kind, k] += 1
                    if base:
                        digest[k] = hashlib.sha256(_joined(base).encode()).hexdigest()
                    extra[k] = len(added)
                    spans[k] = _joined(base + added)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digest), pa.array(spans), pa.array(extra)], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or group of spans that overlap, as the kind of its first in brackets."""
    out, at = [], 0
    for s, kind, e in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind]}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame, field: Field | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans in ``text_col`` masked; null stays null, other columns pass through."""
    small_batches(docs)
    field = field or train()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            change = {}
            for rows, texts in _rounds(column):
                for k, text, (base, added) in zip(rows, texts, find_all(field, texts), strict=True):
                    if base or added:
                        change[k] = masked(text, base + added)
            if change:
                values = column.to_pylist()
                for k, text in change.items():
                    values[k] = text
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, column.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
