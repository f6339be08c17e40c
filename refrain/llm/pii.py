"""Personal data by a semi-Markov conditional random field over candidate spans.

Base spans come from fixed patterns per kind: leftmost, not overlapping within a kind, dropped if a check (octets,
digits, Luhn) fails. They always stay. The field looks for what these patterns miss: addresses with written-out or
spaced signs, phone numbers without a plus sign or with other dashes, card numbers with other separators, network
addresses with written dots.

Candidates. Around every sign of an address and in every chain of digit groups, each sequence of labels or of at
most ``MOST_GROUPS`` whole groups (cards: five) of at most ``LONGEST`` characters is proposed, once for every kind that its number of digits or groups
allows. Boundaries and kinds are thus open; text outside weighs nothing, so stretches without a candidate need no
states and the program over the candidates alone is that over the whole text.

Model. A segment has features of the whole span and its kind (checks, digit groups, separators, brackets, words
before it, digits that go on next to it) and a transition from the segment before it if that ends at most ``NEAR``
characters earlier. ``segment`` chooses the segmentation of highest weight with one state per end and kind; base
spans are forced segments, so nothing overlaps them and they give the kind before and after.

Training. ``fit`` maximises the conditional likelihood with a Gaussian prior around ``prior_weights`` by full
gradients from the forward and backward sums over all segmentations. Examples come from at most ``sample`` snippets
of ``LONGEST`` characters around base spans (the ones with the least hash), which alone reach the driver: each as it
is, with its span rewritten to a wide form, and with a wide form whose check is broken. A lattice holds the
candidates that meet these spans; what else lies in a snippet has no label and teaches nothing. Snippets with more
than ``MOST_ITEMS`` candidates are left out of training.

Edge cases: null and empty texts have no spans; rows that repeat are searched each; a kind never seen in
training keeps its prior weights; an empty table stays empty. All patterns are scanned so that time stays linear
in very long runs of digits or letters. Columns outside ``keep`` and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refrain.llm.wordcut import slices

KINDS = ("email", "ip", "card", "phone")
LONGEST = 96
SAMPLE = 2_000
# Bytes of text that are Python strings at once.
SLICE_BYTES = 1_000_000
NEAR = 3
MOST_GROUPS = 7
MOST_ITEMS = 64
STEPS = 50

Span = tuple[int, int, str]

# The base patterns. Possessive runs and a look behind keep the matches and make them linear.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Wider forms, proposed to the field only: chains of digit groups, and signs with the labels around them.
BETWEEN = r"[ ()./_\[\]\u00a0\u2010-\u2015-]"
CHAIN = re.compile(rf"[+(]{{0,2}}+(?<![0-9])[0-9]++(?:(?:{BETWEEN}{{1,3}}+| ?[\[(]?dot[\])]? ?)[0-9]++)++")
MORE_BEFORE = re.compile(rf"[0-9]{BETWEEN}{{0,2}}\Z")
MORE_BEHIND = re.compile(rf"{BETWEEN}{{0,2}}[0-9]")
GROUP = re.compile("[0-9]+")
SIGN = (re.compile(r"[\[({<] ?(?:at|AT|@) ?[\])}>] ?"), re.compile(" at (?=[A-Za-z0-9])"), re.compile(" AT (?=[A-Za-z0-9])"), re.compile("@ ?"))
DOT = r"(?: ?[\[({<] ?(?:dot|DOT|\.) ?[\])}>] ?| (?:dot|DOT) |\.)"
NEXT_LABEL = re.compile(rf"{DOT}[A-Za-z0-9-]{{1,30}}+")
DOMAIN_LABEL = re.compile("[A-Za-z0-9-]{1,30}+")
LABELS_BEFORE = re.compile(rf"[A-Za-z0-9_%+-]{{1,40}}(?:{DOT}[A-Za-z0-9_%+-]{{1,40}}){{0,3}} ?\Z")
LABEL = re.compile("[A-Za-z0-9_%+-]+")
# Endings of addresses.
ENDINGS = frozenset("com org net edu gov mil int info biz io ai co me app dev uk us de fr es it nl ch at be se no dk fi pl pt ru cn jp kr in br mx ca au nz eu".split())
CUES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "address", "server"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
}


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end(), "email"
        free = at = found.end() if found else at + 1


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind as listed."""
    found = list(_emails(text))
    found += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def wide_spans(text: str) -> list[Span]:
    """Candidates of the field; bounded in number per character."""
    found = set()
    for m in CHAIN.finditer(text):
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        for i, (start, _) in enumerate(groups):
            opened = start
            while opened > m.start() and text[opened - 1] in "+(":
                opened -= 1
            digits = 0
            for j in range(i, min(i + MOST_GROUPS, len(groups))):
                end = groups[j][1]
                digits += end - groups[j][0]
                if digits > 19 or end - opened > LONGEST:
                    break
                if j > i and 7 <= digits <= 15:
                    found.add((opened, end, "phone"))
                if 0 < j - i < 5 and digits >= 12:
                    found.add((start, end, "card"))
                if j == i + 3 and all(e - s <= 3 for s, e in groups[i : j + 1]):
                    found.add((start, end, "ip"))
    for m in (m for sign in SIGN for m in sign.finditer(text)):
        at, ends = max(0, m.start() - LONGEST), []
        label = DOMAIN_LABEL.match(text, m.end())
        while label and len(ends) < 6 and (label := NEXT_LABEL.match(text, label.end())):
            ends.append(label.end())
        before = LABELS_BEFORE.search(text[at : m.start()]) if ends else None
        for label in LABEL.finditer(before[0]) if before else ():
            start = at + before.start() + label.start()
            if label[0].lower() != "dot":
                found |= {(start, end, "email") for end in ends if end - start <= LONGEST}
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], span[0], KINDS.index(span[2])


def features(text: str, span: Span) -> list[str]:
    """Features of a whole segment of a kind."""
    start, end, kind = span
    body = text[start:end]
    out = [f"{kind}:prior"]
    if kind == "email":
        labels = re.findall("[A-Za-z0-9_%+-]+", body)
        plain = "@" not in body and not any(c in body for c in "[({<")
        out += [f"email:ending={labels[-1].lower() in ENDINGS}", f"email:letters={any(c.isalpha() for c in body[:3])}"]
        spoken = "dot" in map(str.lower, labels)
        out += [f"email:plain:spoken={spoken}"] * plain + ["email:plain:name"] * (plain and not labels[0].isalpha())
    else:
        groups = GROUP.findall(body)
        sizes, digits = tuple(map(len, groups)), "".join(groups)
        signs = {g.strip() or " " for g in re.split("[0-9]+", body[body.index(groups[0]) :]) if g}
        out += [f"{kind}:one sign={len(signs) < 2}", f"{kind}:words={'dot' in body}"]
        if kind == "card":
            regular = len(groups) == 1 or set(sizes[:-1]) == {4} and sizes[-1] <= 4 or sizes == (4, 6, 5)
            out += [f"card:luhn={regular and luhn(digits)}", f"card:length={12 <= len(digits) <= 19}", f"card:groups={regular}"]
        elif kind == "phone":
            out += [f"phone:length={9 <= len(digits) <= 15}", f"phone:groups={sizes[-3:] == (3, 3, 4)}"]
            out += ["phone:plus"] * (body[0] == "+") + ["phone:code"] * (sizes[-3:] == (3, 3, 4) and len(sizes) > 3)
            out += ["phone:date"] * (sizes[:3] in ((4, 2, 2), (2, 2, 4))) + ["phone:thousands"] * (set(sizes[1:]) == {3})
            out += ["phone:octets"] * (len(sizes) == 4 and all(n <= 3 for n in sizes))
        else:
            out += [f"ip:octets={len(groups) == 4 and all(len(o) <= 3 and int(o) < 256 for o in groups)}"]
            out += [f"ip:dots={all('.' in s or 'dot' in s for s in signs)}"]
        out += [f"{kind}:goes on"] * bool(MORE_BEFORE.search(text[max(0, start - 3) : start]))
        out += [f"{kind}:goes on"] * bool(MORE_BEHIND.match(text[end : end + 3]))
    out += [f"{kind}:open"] * any(body.count(a) != body.count(b) for a, b in ("()", "[]"))
    before = text[max(0, start - 24) : start].lower()
    out += [f"{kind}:cue"] * any(c in before for c in CUES[kind])
    out += [f"{kind}:inside"] * bool(start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum())
    return out


def near(first: str, second: str) -> str:
    """The transition feature of two segments at most ``NEAR`` characters apart."""
    return f"near:{first}:{second}"


def segment(text: str, candidates: Sequence[Span], weights: dict[str, float], forced: Sequence[Span] = ()) -> list[Span]:
    """The segmentation of highest weight that holds all ``forced`` spans; text outside weighs nothing.

    State: end and kind of the last segment. Candidates in order of their ends extend the states that end before
    they start: those at most ``NEAR`` characters before by the transition of both kinds, of all earlier ones the
    best. Forced spans do not overlap each other or a candidate, weigh nothing themselves, and no state skips one.
    """
    must = set(forced)
    spans = sorted({*(s for s in candidates if s[1] - s[0] <= LONGEST), *must}, key=_order)
    ends = [s[1] for s in spans]
    total, back, top, first = [], [], [], 0
    for i, s in enumerate(spans):
        stop = bisect_right(ends, s[0], first, i)
        close = bisect_left(ends, s[0] - NEAR, first, stop)
        best, last = (0.0, -1) if first == 0 and not (spans[0] in must and i) else (-np.inf, -1)
        if close > first and total[top[close - 1]] > best:
            last = top[close - 1]
            best = total[last]
        for j in range(close, stop):
            value = total[j] + weights.get(near(spans[j][2], s[2]), 0.0)
            if value > best:
                best, last = value, j
        total.append(best + (0.0 if s in must else sum(weights.get(f, 0.0) for f in features(text, s))))
        back.append(last)
        first = i if s in must else first
        top.append(i if i == first or total[i] > total[top[-1]] else top[-1])
    if not spans:
        return []
    at = top[-1]
    if total[at] <= 0 and not must:
        return []
    out = []
    while at >= 0:
        out.append(spans[at])
        at = back[at]
    return out[::-1]


def prior_weights() -> dict[str, float]:
    """Means of the weights before training: a candidate needs its checks."""
    weights = {f"{k}:prior": -1.0 for k in KINDS} | {f"{k}:inside": -2.0 for k in KINDS} | {f"{k}:cue": 0.5 for k in KINDS}
    weights |= {f"{k}:goes on": -2.0 for k in KINDS} | {f"{k}:open": -2.0 for k in KINDS}
    for f in ("card:luhn", "card:length", "card:groups", "phone:length", "phone:groups", "ip:octets", "ip:dots", "email:ending"):
        weights |= {f"{f}=True": 0.75, f"{f}=False": -2.0}
    weights |= {"phone:code": 0.5, "phone:date": -2.0, "phone:thousands": -2.0, "phone:octets": -2.0}
    return weights | {"email:plain:spoken=False": -2.0, "email:plain:spoken=True": 0.0}


def rewritten(body: str, kind: str, form: int) -> str:
    """A base span of a kind written in a form that the base patterns miss."""
    if kind == "email":
        at, dot = ((" at ", " dot "), (" [at] ", "."), (" (at) ", " (dot) "), (" @ ", "."), ("[at]", "[dot]"))[form % 5]
        local, domain = body.rsplit("@", 1)
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return body.replace(".", ("[.]", " dot ", " . ", "(.)", "[dot]")[form % 5])
    digits = "".join(GROUP.findall(body))
    if kind == "card":
        return (".", "/", "_", "–", " ")[form % 5].join(digits[k : k + 4] for k in range(0, len(digits), 4))
    code, a, b, c = digits[:-10], digits[-10:-7], digits[-7:-4], digits[-4:]
    return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{code} {a} {b} {c}".strip(), f"+{code}–{a}–{b}–{c}")[form % 5]


def broken(body: str, kind: str, form: int) -> str:
    """A wide form of a base span without what makes it personal data."""
    if kind == "email":
        local, domain = re.sub("[^A-Za-z]", "", body.rsplit("@", 1)[0]), body.rsplit("@", 1)[1]
        forms = (f"{local} at once dot {local}", f"{local} at noon.then", f"{local} @ noon.then", f"{local} at {domain}", f"{local} at the dot there")
        return forms[form % 5]
    if kind == "card":
        return rewritten(body[:-1] + str((int(body[-1]) + 1) % 10), kind, form)
    if kind == "ip":
        return rewritten("999" + body[body.index(".") :], kind, form)
    d = "".join(GROUP.findall(body))[-10:]
    return (f"20{d[:2]}-0{d[2]}-1{d[3]}", f"1{d[2]}.0{d[3]}.20{d[:2]}", f"{d[0]}.{d[1:4]}.{d[4:7]}.{d[7:]}", f"20{d[:2]} 20{d[2:4]} 20{d[4:6]}", f"{d[:2]}/{d[2:4]}/{d[4:8]}")[form % 5]


def examples(snippets: Sequence[str]) -> list[tuple[str, list[Span], list[Span]]]:
    """Texts with the candidates of their lattices and the true segments among them."""
    out = []

    def add(text: str, gold: list[Span], meets: list[Span]) -> None:
        items = {s for s in wide_spans(text) if any(s[0] < e and b < s[1] for b, e, _ in [*gold, *meets])}
        items = sorted(items.union(gold), key=_order)
        if 0 < len(items) <= MOST_ITEMS:
            out.append((text, items, gold))

    def apart(spans: list[Span]) -> list[Span]:
        kept, reach = [], 0
        for s in spans:
            if s[0] >= reach:
                kept.append(s)
                reach = s[1]
        return kept

    for text in snippets:
        form = int.from_bytes(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()[:4], "big")
        base = apart(base_spans(text))
        add(text, base, [])
        for start, end, kind in base[:1]:
            if kind == "phone" and sum(c.isdigit() for c in text[start:end]) < 10:
                continue
            for make, true in ((rewritten, True), (broken, False)):
                body = make(text[start:end], kind, form)
                new, span = text[:start] + body + text[end:], (start, start + len(body), kind)
                others = apart(base_spans(new))
                if all(s[1] <= span[0] or s[0] >= span[1] for s in others):
                    add(new, sorted([*others, span] if true else others), [span])
    return out


class Lattices:
    """Lattices of similar size as arrays; sums over all their segmentations."""

    def __init__(self, rows: Sequence[tuple[str, list[Span], list[Span]]], number: dict[str, int]):
        n = max(len(items) for _, items, _ in rows)
        coded = [[[number[f] for f in features(text, s)] for s in items] for text, items, _ in rows]
        m = max(len(f) for items in coded for f in items)
        self.index = np.zeros((len(rows), n, m), np.int32)
        start, end = np.full((len(rows), n), 10**6), np.full((len(rows), n), 10**6)
        kind = np.zeros((len(rows), n), np.int64)
        self.real, self.gold = np.zeros((len(rows), n), bool), np.zeros((len(rows), n))
        self.goldpairs = np.zeros(len(number))
        for r, (_, items, gold) in enumerate(rows):
            for i, s in enumerate(items):
                self.index[r, i, : len(coded[r][i])] = coded[r][i]
                start[r, i], end[r, i], kind[r, i] = s[0], s[1], KINDS.index(s[2])
            self.real[r, : len(items)] = True
            self.gold[r, : len(items)] = [s in gold for s in items]
            for a, b in zip(gold, gold[1:], strict=False):
                if b[0] - a[1] <= NEAR:
                    self.goldpairs[number[near(a[2], b[2])]] += 1
        gap = start[:, None, :] - end[:, :, None]
        self.allowed = (gap >= 0) & self.real[:, :, None] & self.real[:, None, :]
        pairs = np.array([[number[near(a, b)] for b in KINDS] for a in KINDS])
        self.pair = np.where(self.allowed & (gap <= NEAR), pairs[kind[:, :, None], kind[:, None, :]], 0)

    def sums(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log of the sum over segmentations, chances of items, chances of neighbours."""
        own = np.where(self.real, weights[self.index].sum(-1), -1e9)
        step = np.where(self.allowed, weights[self.pair], -1e9)
        n = own.shape[1]

        def add(x: np.ndarray) -> np.ndarray:  # log(1 + sum of exp)
            most = x.max(1, initial=0.0)
            return most + np.log(np.exp(-most) + np.exp(x - most[:, None]).sum(1))

        alpha, beta = np.full(own.shape, -1e9), np.zeros(own.shape)
        for j in range(n):
            alpha[:, j] = own[:, j] + add(alpha[:, :j] + step[:, :j, j])
        for i in reversed(range(n)):
            beta[:, i] = add(step[:, i, i + 1 :] + own[:, i + 1 :] + beta[:, i + 1 :])
        log_z = add(alpha)
        item = np.exp(alpha + beta - log_z[:, None])
        both = np.exp(alpha[:, :, None] + step + (own + beta)[:, None, :] - log_z[:, None, None])
        return log_z, item, both

    def gradient(self, weights: np.ndarray) -> np.ndarray:
        """Expected less true counts of the features."""
        _, item, both = self.sums(weights)
        excess = np.repeat((item - self.gold).ravel(), self.index.shape[2])
        out = np.bincount(self.index.ravel(), excess, len(weights)) + np.bincount(self.pair.ravel(), both.ravel(), len(weights))
        out -= self.goldpairs
        out[0] = 0.0
        return out


def fit(snippets: Sequence[str], steps: int = STEPS) -> dict[str, float]:
    """Weights of greatest likelihood with a Gaussian prior around ``prior_weights``, by signs of full gradients."""
    rows = sorted(examples(snippets), key=lambda r: len(r[1]))
    prior = prior_weights()
    names = sorted({f for text, items, _ in rows for s in items for f in features(text, s)} | set(prior))
    names = ["", *names, *(near(a, b) for a in KINDS for b in KINDS)]
    number = {f: k for k, f in enumerate(names)}
    start = np.array([prior.get(f, 0.0) for f in names])
    weights, size, before = start.copy(), np.full(len(names), 0.1), np.zeros(len(names))
    lattices = [Lattices(rows[k : k + 512], number) for k in range(0, len(rows), 512)]
    for _ in range(steps):
        slope = sum((x.gradient(weights) for x in lattices), weights - start)
        turn = slope * before
        size = np.clip(np.where(turn > 0, size * 1.2, np.where(turn < 0, size * 0.5, size)), 1e-4, 0.5)
        slope = np.where(turn < 0, 0.0, slope)
        weights = weights - np.sign(slope) * size
        before = slope
    return dict(zip(names[1:], map(float, weights[1:]), strict=True))


def find(text: str, weights: dict[str, float]) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: these and what the field adds without touching them."""
    base = base_spans(text)
    wide = wide_spans(text)
    if not wide:  # the base spans are the only segmentation
        return base, base
    blocks: list[Span] = []  # base spans of several kinds that overlap are one forced segment
    for s in sorted(base):
        if blocks and s[0] < blocks[-1][1]:
            last = blocks.pop()
            s = (last[0], *max(last[1:], s[1:]))
        blocks.append(s)
    starts = [b[0] for b in blocks]
    clear = [s for s in wide if not (k := bisect_left(starts, s[1])) or blocks[k - 1][1] <= s[0]]
    if not clear:
        return base, base
    added = set(segment(text, clear, weights, blocks)) - set(blocks)
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2])))


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> dict[str, float]:
    """Weights learned on at most ``sample`` snippets of ``docs``."""

    def snippets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = set()
            for t in (x.as_py() for x in b.column(0)):
                for start, end, _ in base_spans(t or ""):
                    if end - start <= LONGEST // 2:
                        at = max(0, start - LONGEST // 4)
                        out.add(t[at : at + LONGEST])
            kept = sorted(out, key=lambda t: hashlib.md5(t.encode("utf-8", "surrogatepass")).digest())[:sample]
            yield pa.record_batch([pa.array(kept, pa.string())], names=["snippet"])

    found = docs.select(F.col(text).cast("string")).mapInArrow(snippets, "snippet string")
    rows = found.distinct().orderBy(F.md5(F.col("snippet"))).limit(sample).collect()
    return fit([r.snippet for r in rows])


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the union is replaced once."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(out) + text[at:]


def detect(docs: DataFrame, weights: dict[str, float], text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` with base and all spans (arrays of start, end and kind) and the masked text of every document."""
    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    keep = list(keep)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    schema = ", ".join(
        [*(f"`{c}` {types[c]}" for c in keep), *(f"{c} array<struct<start: bigint, end: bigint, kind: string>>" for c in ("base", "spans")), "masked string"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 0, SLICE_BYTES):
                texts = b.column(0).to_pylist()
                found = [find(t or "", weights) for t in texts]
                rows = lambda k: [[dict(zip(("start", "end", "kind"), s, strict=True)) for s in f[k]] for f in found]  # noqa: B023, E731
                clean = [None if t is None else masked(t, f[1]) for t, f in zip(texts, found, strict=True)]
                spans = [pa.array(rows(k), pa.list_(span)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[1:], *spans, pa.array(clean, pa.string())], names=[*keep, "base", "spans", "masked"]
                )

    source = docs.select(F.col(text).cast("string").alias("_text"), *keep)
    return source.mapInArrow(run, schema)
