"""Personal data in texts: fixed patterns, extended by a skip-chain conditional random field.

Patterns find what is certain. The field then judges the other mentions of a text, stretches that
look like numbers or addresses but fit no pattern. Its variables are all mentions, labelled as one
of the kinds or as nothing; those of the patterns are given. Potentials join a mention with its own
shape and the word before it, with the next mention near it (the chain), and with distant mentions
that repeat it or are like it (the skips): the same digits written otherwise, a number's end, a
number with one digit changed, an address's name. A skip favours equal labels, nothing included,
so uncertain mentions do not talk each other into a kind. Labels follow from loopy message passing over each
text, so what a text says in full once is also found where it is shortened or mistyped later.

The links of a group of like mentions lead to its first certain mention of each kind, or to its
first if none is certain, so there are fewer than five times as many links as mentions. Weights are learned by
pseudo-likelihood from a bounded sample of texts: the mentions themselves, and rewritings of certain
ones, alone and linked to their originals.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.tables import small_batches

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
NOTHING = 4
LABELS = 5

# Texts of the sample that weights are learned from, and mentions taken from each.
SAMPLE = 20_000
SAMPLE_MENTIONS = 64
SAMPLE_CHARS = 100
# Neighbouring mentions at most so many characters apart have a chain potential.
NEAR = 40
ROUNDS, DAMPING, SETTLED = 50, 0.5, 1e-4
LEAST_PROBABILITY = 0.5
WORD_BUCKETS = 64
FEATURES = 26 + WORD_BUCKETS
LINKS = ("same", "end", "half", "name")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOTTED = re.compile(r"[0-9][0-9.]*")
QUAD = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
DIGITS_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
PLUS_NUMBER = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ANY_SIGN = re.compile(r"[0-9@]|[\[( ]at[\]) ]")
NUMBER = re.compile(r"(?<![^\W_])[+(]?[0-9]++(?:[ ().-]{1,2}[0-9]++)*+(?![^\W_])")
AT = re.compile(r" ?(?:\[ ?at ?\]|\( ?at ?\)) ?| at ", re.I)
SPELLED_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?: ?\[ ?dot ?\] ?| ?\( ?dot ?\) ?| dot |\.)[A-Za-z0-9-]{1,63}){1,8}", re.I
)
NAME = re.compile(r"[A-Za-z0-9._%+-]{5,64}")
WORD_BEFORE = re.compile(r"([^\W\d_]{2,20})[^\w]{0,3}\Z")
NOT_DIGIT = re.compile(r"[^0-9]+")


def passes_luhn(digits: str) -> bool:
    """Whether the check digit is right: every second digit from the right counts double."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of what the patterns find, by start and then kind.

    Each kind is matched from left to right without overlaps of its own; matches that fail their
    check are dropped and not tried shorter. Time grows with the length of the text alone: an
    address is looked for around its sign, and no stretch of digits is begun twice.
    """
    out = []
    ended = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > ended and text[begin - 1] in LOCAL_CHARS:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            ended = domain.end()
            out.append((begin, EMAIL, ended))
        at = text.find("@", at + 1)
    for stretch in DOTTED.finditer(text):
        if stretch[0].count(".") < 3:
            continue
        for quad in QUAD.finditer(text, *stretch.span()):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in quad.groups()):
                out.append((quad.start(), IP, quad.end()))
    for number in DIGITS_CARD.finditer(text):
        if 12 <= number.end() - number.start():
            digits = number[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                out.append((number.start(), CARD, number.end()))
    for number in PLUS_NUMBER.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", number[0])) <= 15:
            out.append((number.start(), PHONE, number.end()))
    return sorted(out)


@dataclass
class Mention:
    start: int
    end: int
    text: str
    before: str
    kind: int  # of a pattern, or NOTHING


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[Mention]:
    """The certain mentions and, outside of them, the possible ones, in order."""
    gaps, at = [], 0
    for start, _, end in base:
        if start > at:
            gaps.append((at, start))
        at = max(at, end)
    if at < len(text):
        gaps.append((at, len(text)))
    names = {
        name.lower()
        for start, kind, end in base
        if kind == EMAIL and len(name := text[start : text.index("@", start, end)]) >= 5 and re.search(r"[\d._]", name)
    }
    spans = [(start, end, kind) for start, kind, end in base]
    for a, b in gaps:
        taken = a
        found = []
        for sign in AT.finditer(text, a, b):
            begin = sign.start()
            while begin > max(taken, sign.start() - 64) and text[begin - 1] in LOCAL_CHARS:
                begin -= 1
            domain = SPELLED_DOMAIN.match(text, sign.end(), b) if begin < sign.start() else None
            if domain:
                found.append((begin, domain.end(), NOTHING))
                taken = domain.end()
        if names:
            for name in NAME.finditer(text, a, b):
                if name[0].rstrip(".").lower() in names:
                    found.append((name.start(), name.start() + len(name[0].rstrip(".")), NOTHING))
        for number in NUMBER.finditer(text, a, b):
            if 7 <= sum(map(str.isdigit, number[0])) <= 19:
                found.append((*number.span(), NOTHING))
        last = a
        for start, end, kind in sorted(found):
            if start >= last:
                spans.append((start, end, kind))
                last = end
    return [
        Mention(start, end, text[start:end], _word_before(text, start), kind) for start, end, kind in sorted(spans)
    ]


def _word_before(text: str, start: int) -> str:
    found = WORD_BEFORE.search(text[max(0, start - 24) : start])
    return found[1].lower() if found else ""


def features(text: str, before: str) -> np.ndarray:
    """What the field sees of one mention: its shape, and a bucket of the word before it."""
    digits = NOT_DIGIT.sub("", text)
    groups = re.findall("[0-9]+", text)
    sizes = list(map(len, groups))
    separators = set(re.findall(r"(?<=[0-9])[^0-9]+(?=[0-9])", text))
    n = len(digits)
    letters = bool(re.search("[A-Za-z]", text))
    long = not letters and 12 <= n <= 19
    told = [
        True,
        "+" in text,
        "(" in text and not letters,
        separators == {"-"},
        separators == {"."},
        separators == {" "},
        len(separators) > 1,
        not separators,
        long and passes_luhn(digits),
        long and not passes_luhn(digits),
        not letters and len(groups) == 4 and all(s <= 3 and int(g) <= 255 for s, g in zip(sizes, groups, strict=True)),
        not letters and sizes[-2:] == [3, 4],
        not letters and sizes[-3:] == [3, 3, 4],
        *[not letters and n == size for size in (7, 8, 9, 10, 11)],
        not letters and 12 <= n <= 15,
        not letters and n == 16,
        not letters and 17 <= n <= 19,
        "@" in text,
        letters and bool(re.search(r"[\[(]", text)),
        letters and bool(re.search(r" at .* dot ", text, re.I)),
        letters and "@" not in text and " " not in text and "[" not in text and "(" not in text,
        len(sizes) > 2 and set(sizes) == {4},
    ]
    out = np.zeros(FEATURES)
    out[: len(told)] = told
    if before:
        out[len(told) + zlib.crc32(before.encode()) % WORD_BUCKETS] = 1
    return out


def link_keys(mention: Mention) -> list[tuple[str, str]]:
    """Names of the groups of like mentions that a mention is in, with the kind of link."""
    text = mention.text
    if "@" in text or re.search("[A-Za-z]", text):
        plain = re.sub(r" ?[\[(] ?at ?[\])] ?| at ", "@", text, flags=re.I)
        plain = re.sub(r" ?[\[(] ?dot ?[\])] ?| dot ", ".", plain, flags=re.I).lower()
        return [("same", plain), ("name", plain.split("@")[0])]
    digits = NOT_DIGIT.sub("", text)
    keys = [("same", digits)]
    if len(digits) >= 7:
        keys.append(("end", digits[-7:]))
    if len(digits) >= 12:
        # One changed digit leaves a half as it is.
        half = len(digits) // 2
        keys += [("half", f"{len(digits)}<{digits[:half]}"), ("half", f"{len(digits)}>{digits[half:]}")]
    return keys


def links(found: list[Mention]) -> list[tuple[int, int, int]]:
    """``(anchor, mention, kind of link)``; the strongest kind for each pair, with the anchors of
    each group."""
    groups: dict[tuple[str, str], list[int]] = {}
    for i, mention in enumerate(found):
        for key in link_keys(mention):
            groups.setdefault(key, []).append(i)
    out: dict[tuple[int, int], int] = {}
    for (name, _), members in groups.items():
        if len(members) < 2:
            continue
        anchors: dict[int, int] = {}
        for i in members:
            if found[i].kind != NOTHING:
                anchors.setdefault(found[i].kind, i)
        for a in anchors.values() or members[:1]:
            for i in members:
                if i != a and found[i].kind == NOTHING:
                    pair, kind = (min(a, i), max(a, i)), LINKS.index(name)
                    out[pair] = min(kind, out.get(pair, kind))
    return [(a, b, kind) for (a, b), kind in out.items()]


def neighbours(found: list[Mention]) -> list[tuple[int, int]]:
    return [(i, i + 1) for i in range(len(found) - 1) if 0 <= found[i + 1].start - found[i].end <= NEAR]


@dataclass
class Field:
    """Log-potentials: ``shape[label, feature]``, ``chain[label, next label]``, ``skip[link]``."""

    shape: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def blank(cls) -> Field:
        return cls(np.zeros((LABELS, FEATURES)), np.zeros((LABELS, LABELS)), np.zeros(len(LINKS)))

    def between(self, edges: np.ndarray) -> np.ndarray:
        """The potentials of edges (kind -1: chain, else the kind of link), by labels of both ends."""
        tables = np.zeros((len(LINKS) + 1, LABELS, LABELS))
        for kind, weight in enumerate(self.skip):
            tables[kind][range(LABELS), range(LABELS)] = weight
        tables[-1] = self.chain
        return tables[edges]


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(own: np.ndarray, ends: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Label probabilities of all variables by loopy sum-product message passing.

    ``own`` are log-potentials by variable, ``ends`` pairs of variables, ``between`` their
    log-potentials. All messages of a round are sent at once, damped; on graphs without loops the
    result is exact.
    """
    back = between.transpose(0, 2, 1)
    source = np.concatenate([ends[:, 0], ends[:, 1]]) if len(ends) else np.zeros(0, int)
    target = np.concatenate([ends[:, 1], ends[:, 0]]) if len(ends) else np.zeros(0, int)
    table = np.concatenate([between, back])
    opposite = np.concatenate([np.arange(len(ends)) + len(ends), np.arange(len(ends))])
    sent = np.zeros((len(source), LABELS))
    for _ in range(ROUNDS if len(ends) else 0):
        belief = own.copy()
        np.add.at(belief, target, sent)
        out = _log_sum((belief[source] - sent[opposite])[:, :, None] + table, axis=1)
        out -= _log_sum(out, axis=1)[:, None]
        change = np.abs(np.exp(out) - np.exp(sent)).max()
        sent = out if change < SETTLED else DAMPING * sent + (1 - DAMPING) * out
        if change < SETTLED:
            break
    belief = own.copy()
    np.add.at(belief, target, sent)
    return np.exp(belief - _log_sum(belief, axis=1)[:, None])


def added_spans(found: list[Mention], field: Field) -> list[tuple[int, int, int, float]]:
    """``(start, kind, end, probability)`` of the possible mentions that the field gives a kind."""
    open_ = [i for i, m in enumerate(found) if m.kind == NOTHING]
    if not open_:
        return []
    own = np.full((len(found), LABELS), -50.0)
    for i, mention in enumerate(found):
        if mention.kind == NOTHING:
            own[i] = field.shape @ features(mention.text, mention.before)
        else:
            own[i, mention.kind] = 0.0
    edges = [(a, b, -1) for a, b in neighbours(found)] + links(found)
    ends = np.array([e[:2] for e in edges], int).reshape(-1, 2)
    chances = marginals(own, ends, field.between(np.array([e[2] for e in edges], int)))
    out = []
    for i in open_:
        label = int(chances[i].argmax())
        if label != NOTHING and chances[i, label] >= LEAST_PROBABILITY:
            out.append((found[i].start, label, found[i].end, float(chances[i, label])))
    return out


def rewritings(text: str, kind: int) -> list[tuple[str, bool]]:
    """Other ways to write a certain mention, and whether each is clear without the original."""
    digits = NOT_DIGIT.sub("", text)
    if kind == EMAIL:
        name, domain = text.split("@", 1)
        spelled = domain.replace(".", " dot ")
        out = [(f"{name} [at] {domain}", True), (f"{name} (at) {domain}", True), (f"{name} at {domain}", False)]
        out.append((f"{name} at {spelled}", True))
        if len(name) >= 5 and re.search(r"[\d._]", name):
            out.append((name, False))
        return out
    if kind == IP:
        return [(text.replace(".", "-"), False), (text.replace(".", " "), False), (text.replace(".", ". "), False)]
    if kind == CARD:
        out = []
        for place in (1, len(digits) // 2, len(digits) - 1):
            changed = digits[:place] + str((int(digits[place]) + 3) % 10) + digits[place + 1 :]
            fours = " ".join(changed[i : i + 4] for i in range(0, len(changed), 4))
            out += [(changed, False), (fours, False)]
        return out
    last = digits[-10:]
    out = [(digits, False), (last, False), (f"{digits[-7:-4]}-{digits[-4:]}", False), (digits[-7:], False)]
    if len(last) == 10:
        out += [(f"({last[:3]}) {last[3:6]}-{last[6:]}", True)]
        out += [(f"{last[:3]}{c}{last[3:6]}{c}{last[6:]}", c != " ") for c in "-. "]
    return out


def fit(sample: list[list[tuple[int, str, str, int]]], steps: int = 300, decay: float = 2e-3) -> Field:
    """Weights from lists of ``(kind, text, word before, distance to the next)``, one per text.

    The likelihood of each label given the labels around it, with a penalty on large weights, is
    raised by gradient steps. Mentions that no pattern accepts count as nothing.
    """
    rows: dict[tuple, float] = {}

    def example(label: int, text: str, before: str, near: tuple[int, ...] = (), link: int = -1, other: int = -1) -> None:
        key = (label, text, before, near, link, other)
        rows[key] = rows.get(key, 0.0) + 1.0

    for listed in sample:
        for i, (kind, text, before, _) in enumerate(listed):
            near = []
            if i and listed[i - 1][3] <= NEAR:
                near.append(listed[i - 1][0])
            if i + 1 < len(listed) and listed[i][3] <= NEAR:
                near.append(listed[i + 1][0])
            example(kind, text, before, tuple(near))
            if kind == NOTHING:
                continue
            for other, clear in rewritings(text, kind):
                example(kind if clear else NOTHING, other, before)
                pair = [Mention(0, 1, text, "", kind), Mention(90, 91, other, "", NOTHING)]
                for *_, link in links(pair):
                    example(kind, other, before, (), link, kind)
    field = Field.blank()
    if not rows:
        field.shape[NOTHING, 0] = 10.0
        return field
    keys = list(rows)
    shapes: dict[tuple[str, str], np.ndarray] = {}
    x = np.array([shapes.setdefault(k[1:3], features(*k[1:3])) for k in keys])
    label = np.array([k[0] for k in keys])
    weight = np.sqrt(np.array([rows[k] for k in keys]))
    weight /= weight.sum()
    near = np.zeros((len(keys), LABELS))
    for i, key in enumerate(keys):
        for other in key[3]:
            near[i, other] += 1
    linked = np.flatnonzero([k[4] >= 0 for k in keys])
    link, other = (np.array([keys[i][j] for i in linked], int) for j in (4, 5))
    wanted = np.zeros((len(keys), LABELS))
    wanted[np.arange(len(keys)), label] = 1
    weights = [field.shape, field.chain, field.skip]
    gathered = [np.full(w.shape, 1e-8) for w in weights]
    for _ in range(steps):
        score = x @ field.shape.T + near @ field.chain
        np.add.at(score, (linked, other), field.skip[link])
        miss = (np.exp(score - _log_sum(score, axis=1)[:, None]) - wanted) * weight[:, None]
        towards = [miss.T @ x, near.T @ miss, np.bincount(link, miss[linked, other], len(LINKS))]
        towards[1] = (towards[1] + towards[1].T) / 2
        for w, slope, past in zip(weights, towards, gathered, strict=True):
            slope = slope + decay * w / max(w.size, 1)
            past += slope * slope
            w -= 0.5 * slope / np.sqrt(past)
    return field


def learn_personal_data(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> Field:
    """Learn the field from about ``sample`` of the texts that hold a digit or an at sign.

    Texts are drawn by a hash of id and text. Mentions longer than ``SAMPLE_CHARS``, and those of a
    text beyond the first ``SAMPLE_MENTIONS``, do not teach; what is found is not limited by either.
    Texts without mentions give a field that adds nothing.
    """
    small_batches(docs.sparkSession)
    worth = docs.where(F.col(text_col).rlike("[0-9@]")).select(
        F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("draw")
    )
    many = worth.count()
    if not many:
        return fit([])
    share = math.ceil(min(1.0, sample / many) * (1 << 20))

    @F.arrow_udf("array<struct<kind:int,text:string,before:string,gap:int>>")
    def told(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            found = mentions(text, base_spans(text))[: SAMPLE_MENTIONS + 1]
            after = [*(m.start for m in found[1:]), 1 << 30]
            out.append(
                [
                    {"kind": m.kind, "text": m.text, "before": m.before, "gap": max(0, min(a - m.end, 1 << 30))}
                    for m, a in zip(found[:SAMPLE_MENTIONS], after, strict=False)
                    if m.end - m.start <= SAMPLE_CHARS
                ]
            )
        kind = pa.struct([("kind", pa.int32()), ("text", pa.string()), ("before", pa.string()), ("gap", pa.int32())])
        return pa.array(out, pa.list_(kind))

    drawn = (
        worth.where(F.pmod("draw", F.lit(1 << 20)) < share)
        .select("draw", told("text").alias("found"))
        .where(F.size("found") > 0)
        .collect()
    )
    return fit([[tuple(m) for m in row.found] for row in sorted(drawn)])


def find_personal_data(
    docs: DataFrame, field: Field, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id and ``found``, spans ``(kind, start, end, certain, probability)``.

    Spans count code points, the end exclusive, and come by start and then by kind as in ``KINDS``.
    ``certain`` ones are those of the patterns; the field only adds to them, outside of them. Null
    and empty texts have none. Repeated rows are judged each, whole texts however long. Empty input
    gives no rows.
    """
    small_batches(docs.sparkSession)
    ddl = "array<struct<kind:string,start:int,end:int,certain:boolean,probability:double>>"

    @F.arrow_udf(ddl)
    def find(texts: pa.Array) -> pa.Array:
        counts, columns = [0], ([], [], [], [], [])
        for scalar in texts:
            text = scalar.as_py()
            if text and ANY_SIGN.search(text):
                base = base_spans(text)
                spans = [(*span, True, 1.0) for span in base]
                for start, kind, end, chance in added_spans(mentions(text, base), field):
                    spans.append((start, kind, end, False, chance))
                for start, kind, end, certain, chance in sorted(spans):
                    for column, value in zip(columns, (KINDS[kind], start, end, certain, chance), strict=True):
                        column.append(value)
            counts.append(len(columns[0]))
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.bool_(), pa.float64())
        names = ("kind", "start", "end", "certain", "probability")
        values = pa.StructArray.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=list(names)
        )
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)

    return docs.select(F.col(id_col), find(F.col(text_col)).alias("found"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
