"""Personal data in texts: base patterns, and a linear-chain CRF over word shapes.

The CRF labels words (white-space separated) as email, ip, card, phone or other. Its features are
the shapes of a word and of its neighbours. Words without a digit or an ``@`` can only be
other, so a text falls into runs of the remaining words, which Viterbi decodes exactly, many
runs at once. A labelled span is trimmed of punctuation, must pass its kind's check, and is
added only where no base span lies.

The CRF is trained on the driver from a small labelled table (``examples`` by default; any
DataFrame of text and spans up to ``MAX_EXAMPLES`` rows is taken).

Null texts count as empty and have no spans. Texts are read whole; time is linear in their
length. Rows with one doc_id are separate documents and give a row each; a null doc_id stays null.
No rows give no rows. Other columns of the input are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT_COLUMNS, WORD, batch, cuts, given_back, runs, text_of

KINDS = ["email", "ip", "card", "phone"]
OTHER = 0  # the label; kinds follow in their order
MAX_EXAMPLES = 5000
CACHED_SIGNS = 500  # scores of longer shapes are not kept
Span = tuple[int, int, int]  # start, kind's index, end

# The contract's patterns, with possessive repeats and run starts, which match the same.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_HOT = re.compile(r"[0-9@]")
_WORD = re.compile(WORD)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def ip_parts_fit(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)


def card_fits(text: str) -> bool:
    digits = digits_of(text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def phone_fits(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """The base matches, by start and then kind."""
    found: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, 0, free))
        else:
            free = at + 1
        at = text.find("@", max(free, at + 1))
    if _DIGIT.search(text):
        for kind, pattern, fits in ((1, _IP, ip_parts_fit), (2, _CARD, card_fits), (3, _PHONE, phone_fits)):
            found += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if fits(m[0])]
    return sorted(found)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---- word shapes -------------------------------------------------------------------


def shape(word: str) -> str:
    """Letters as A or a, digits as 9, runs as one sign with a digit run's rounded length."""
    out, last, n = [], "", 0
    for c in [*word, ""]:
        sign = "9" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c
        if sign == last:
            n += 1
            continue
        if last == "9":
            out.append("9" + (str(n) if n < 5 else "m" if n < 12 else "l" if n < 20 else "x"))
        elif last:
            out.append(last)
        last, n = sign, 1
    return "".join(out)


_COARSE = re.compile(r"9[0-9mlx]")


def features(before: str, here: str, after: str) -> list[str]:
    """Feature names of a word from its shape and its neighbours' ('' at a text's end)."""
    coarse = _COARSE.sub("9", here)
    flags = [f for f in "@.-()+/:#$%=\"'" if f in here]
    return [
        "bias",
        "shape " + here,
        "coarse " + coarse,
        "signs " + "".join(flags),
        *("has " + f for f in flags),
        "first " + here[:1],
        "last " + coarse[-1:],
        "letters " + str("a" in here or "A" in here),
        "before " + before,
        "after " + after,
        "before signs " + _COARSE.sub("9", before)[-3:],
        "after signs " + _COARSE.sub("9", after)[:3],
    ]


@dataclass
class Run:
    """Consecutive words that may be personal data, with their neighbours' shapes."""

    doc: int
    places: list[tuple[int, int]]
    keys: list[tuple[str, str, str]]


def runs_of(doc: int, text: str) -> Iterator[Run]:
    hot_at = [m.start() for m in _HOT.finditer(text)]
    if not hot_at:
        return
    words = [m.span() for m in _WORD.finditer(text)]
    starts = np.array([s for s, _ in words])
    hot = np.unique(np.searchsorted(starts, hot_at, "right") - 1)
    for part in np.split(hot, np.flatnonzero(np.diff(hot) > 1) + 1):
        first, last = int(part[0]), int(part[-1])
        shapes = [shape(text[s:e]) for s, e in words[max(first - 1, 0) : last + 2]]
        around = [*[""] * (first == 0), *shapes, *[""] * (last == len(words) - 1)]
        yield Run(doc, words[first : last + 1], list(zip(around, around[1:], around[2:], strict=False)))


# ---- the CRF -----------------------------------------------------------------------


@dataclass
class Crf:
    """Weights by feature and label, and transitions; a run is preceded and followed by other."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def scores(self, key: tuple[str, str, str]) -> np.ndarray:
        known = [self.index[f] for f in features(*key) if f in self.index]
        return self.weights[known].sum(axis=0)

    def decode(self, keys: list[list[tuple[str, str, str]]], cache: dict) -> list[np.ndarray]:
        """The best labels of each run; runs advance together, longest first."""
        for run in keys:
            for key in run:
                if key not in cache and sum(map(len, key)) <= CACHED_SIGNS:
                    if len(cache) > 200_000:
                        cache.clear()
                    cache[key] = self.scores(key)
        lengths = np.array([len(r) for r in keys])
        order = np.argsort(-lengths, kind="stable")
        first = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
        emit = np.array([cache.get(k) if k in cache else self.scores(k) for i in order for k in keys[i]])
        back = np.zeros(emit.shape, np.int8)
        value = emit[first] + self.moves[OTHER]
        sorted_lengths = lengths[order]
        active = len(order)
        for t in range(1, int(sorted_lengths[0])):
            active = int(np.searchsorted(-sorted_lengths[:active], -t, "left"))
            options = value[:active, :, None] + self.moves[None]
            back[first[:active] + t] = options.argmax(axis=1)
            value[:active] = options.max(axis=1) + emit[first[:active] + t]
        labels = np.zeros(len(emit), np.int8)
        labels[first + sorted_lengths - 1] = (value + self.moves[:, OTHER]).argmax(axis=1)
        for t in range(int(sorted_lengths[0]) - 1, 0, -1):
            active = int(np.searchsorted(-sorted_lengths, -t, "left"))
            at = first[:active] + t
            labels[at - 1] = back[at, labels[at]]
        out: list[np.ndarray] = [labels[:0]] * len(keys)
        for i, begin, n in zip(order, first, sorted_lengths, strict=True):
            out[i] = labels[begin : begin + n]
        return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[str, list[tuple[str, int, int]]]], steps: int = 150, l2: float = 0.02) -> Crf:
    """A CRF from texts with (kind, start, end) spans, by gradient steps on its log-likelihood."""
    if len(rows) > MAX_EXAMPLES:
        raise ValueError(f"at most {MAX_EXAMPLES} labelled texts are taken, not {len(rows)}")
    found: list[tuple[Run, list[int]]] = []
    for text, spans in rows:
        for run in runs_of(0, text or ""):
            gold = [OTHER] * len(run.places)
            for i, (s, e) in enumerate(run.places):
                for kind, begin, end in spans:
                    if s < end and begin < e:
                        gold[i] = KINDS.index(kind) + 1
            found.append((run, gold))
    index: dict[str, int] = {}
    for run, _ in found:
        for key in run.keys:
            for f in features(*key):
                index.setdefault(f, len(index))
    k = len(KINDS) + 1
    model = Crf(index, np.zeros((len(index), k)), np.zeros((k, k)))
    if not found:
        model.moves[OTHER, OTHER] = 1.0
        return model
    # Longest first: the runs that have a word at t are the first ``active[t]``.
    found.sort(key=lambda pair: -len(pair[1]))
    n, width = len(found), len(found[0][1])
    mask = np.zeros((n, width), bool)
    gold = np.zeros((n, width), int)
    for i, (run, labels) in enumerate(found):
        mask[i, : len(labels)], gold[i, : len(labels)] = True, labels
    # Each word's features one after another, words in the order of ``mask``.
    held = [[index[f] for f in features(*key)] for run, _ in found for key in run.keys]
    sizes = np.array([len(h) for h in held])
    flat, begins, word = np.concatenate(held), np.cumsum(sizes) - sizes, np.repeat(np.arange(len(held)), sizes)
    truth = np.eye(k)[gold]
    last = mask.sum(axis=1) - 1
    rows_ix, active = np.arange(n), mask.sum(axis=0)
    padded = np.concatenate([np.zeros((n, 1), int), np.where(mask, gold, OTHER), np.zeros((n, 1), int)], axis=1)
    real = np.concatenate([np.ones((n, 1), bool), mask], axis=1)
    counted = np.zeros((k, k))
    np.add.at(counted, (padded[:, :-1][real], padded[:, 1:][real]), 1)
    state = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    second = [np.zeros_like(model.weights), np.zeros_like(model.moves)]
    for step in range(1, steps + 1):
        emit = np.zeros((n, width, k))
        emit[mask] = np.add.reduceat(model.weights[flat], begins)
        moves = model.moves
        alpha, beta = np.zeros((n, width, k)), np.zeros((n, width, k))
        alpha[:, 0] = emit[:, 0] + moves[OTHER]
        for t in range(1, width):
            m = active[t]
            alpha[:m, t] = _logsumexp(alpha[:m, t - 1, :, None] + moves[None], 1) + emit[:m, t]
        total = _logsumexp(alpha[rows_ix, last] + moves[:, OTHER], 1)
        beta[rows_ix, last] = moves[:, OTHER]
        for t in range(width - 2, -1, -1):
            m = active[t + 1]
            beta[:m, t] = _logsumexp(moves[None] + (emit[:m, t + 1] + beta[:m, t + 1])[:, None, :], 2)
        marginal = np.zeros((n, width, k))
        marginal[mask] = np.exp(alpha[mask] + beta[mask] - np.repeat(total, last + 1)[:, None])
        missed = (truth[mask] - marginal[mask])[word]
        summed = np.stack([np.bincount(flat, missed[:, y], len(index)) for y in range(k)], axis=1)
        grads = [summed - l2 * n * 0.01 * model.weights, counted.copy()]
        grads[1][OTHER] -= marginal[:, 0].sum(axis=0)
        grads[1][:, OTHER] -= marginal[rows_ix, last].sum(axis=0)
        for t in range(1, width):
            m = active[t]
            pair = alpha[:m, t - 1, :, None] + moves[None] + (emit[:m, t] + beta[:m, t])[:, None, :]
            grads[1] -= np.exp(pair - total[:m, None, None]).sum(axis=0)
        grads[1] -= l2 * model.moves
        for p, g, m, v in zip((model.weights, model.moves), grads, state, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def examples(count: int = 900, seed: int = 11) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small labelled table made by rule: neutral words around personal data and look-alikes."""
    rng = random.Random(seed)

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def name() -> str:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))

    def neutral() -> str:
        word = name()
        return rng.choice([word, word, word.capitalize(), word + rng.choice(",.:;"), word.capitalize() + ":"])

    def card() -> str:
        body = rng.choice("3456") + digits(14)
        full = next(body + d for d in "0123456789" if luhn(body + d))
        sep = rng.choice(["", "", " ", "-", "."])
        return sep.join(full[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice(
            [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{digits(2)} {digits(2)} {c} {digits(4)}", f"+1-{a}-{b}-{c}"]
        )

    makers = {
        "email": lambda: name() + rng.choice(["", ".", "_", "+"]) + name() + rng.choice(["", digits(2)]) + "@" + name() + rng.choice([".com", ".org", ".co.uk", digits(1) + ".example.com"]),
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": phone,
    }
    plain = [
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/{rng.randint(1900, 2030)}",
        lambda: f"{rng.randint(0, 23)}:{digits(2)}",
        lambda: digits(rng.randint(1, 7)),
        lambda: digits(rng.randint(8, 11)),
        lambda: digits(rng.randint(12, 19)),
        lambda: f"{rng.randint(0, 9)}.{rng.randint(0, 9)}" + rng.choice(["", ".", "." + digits(1)]),
        lambda: f"{rng.randint(0, 9)}.",
        lambda: f"{digits(1)},{digits(3)}",
        lambda: f"${digits(2)}.{digits(2)}",
        lambda: '"' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"',
        lambda: "#" + digits(5),
        lambda: "@" + name(),
        lambda: name() + digits(2),
        lambda: name().upper() + "-" + digits(4),
        lambda: f"{digits(3)}-{digits(4)}",
        lambda: f"{digits(1)}-{digits(3)}-{digits(5)}-{digits(1)}",
        lambda: f"{digits(2)}%",
    ]
    rows = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(rng.randint(1, 4)):
            text += " ".join(neutral() for _ in range(rng.randint(0, 3)))
            text += " " if text and not text.endswith(" ") else ""
            if rng.random() < 0.45:
                kind = rng.choice(KINDS)
                value = makers[kind]()
                lead, tail = rng.choice(["", "", "", "", "", "", "(", "(", "<", "<", "===", "***"]), rng.choice(["", "", "", ".", ",", ")", "###"])
                start = len(text) + len(lead)
                text += lead + value + tail
                spans.append((kind, start, start + len(value)))
            else:
                text += rng.choice(plain)() + rng.choice(["", "", ",", "."])
            text += " "
        rows.append((text + neutral(), spans))
    return rows


# ---- the operator ------------------------------------------------------------------

_TRIM = " \t\n\x0b\x0c\r.,;:!?\"'<>[]{}#*&%$|=_"
_CHECKS = [
    lambda t: re.fullmatch(r"[^@]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t) is not None,
    ip_parts_fit,
    card_fits,
    phone_fits,
]


def added_spans(text: str, run: Run, labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Labelled spans, trimmed and checked, where no base span lies."""
    out, i = [], 0
    while i < len(labels):
        j = i + 1
        label = int(labels[i])
        while label >= 3 and j < len(labels) and labels[j] == label:
            j += 1  # cards and phones may be several words
        if label != OTHER:
            s, e = run.places[i][0], run.places[j - 1][1]
            while s < e and text[s] in _TRIM:
                s += 1
            while e > s and text[e - 1] in _TRIM:
                e -= 1
            # A bracket belongs to the span only with its partner.
            while s < e and text[s] == "(" and text[s:e].count("(") > text[s:e].count(")"):
                s += 1
            while s < e and text[e - 1] == ")" and text[s:e].count(")") > text[s:e].count("("):
                e -= 1
            if text[s : s + 2] == "((" and text[s:e].endswith(")"):
                s, e = s + 1, e - 1
            free = not any(s < be and bs < e for bs, _, be in base)
            if s < e and free and _CHECKS[label - 1](text[s:e]):
                out.append((s, label - 1, e))
        i = j
    return out


def spans_of(texts: list[str], model: Crf, cache: dict) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and all its spans."""
    base = [base_spans(t) for t in texts]
    found = [list(b) for b in base]
    todo = [r for i, t in enumerate(texts) for r in runs_of(i, t)]
    if todo:
        for run, labels in zip(todo, model.decode([r.keys for r in todo], cache), strict=True):
            found[run.doc] += added_spans(texts[run.doc], run, labels, base[run.doc])
    return [(b, sorted(a)) for b, a in zip(base, found, strict=True)]


def trained(labelled: DataFrame | None) -> Crf:
    """The CRF from a table of text and spans (array of kind, start, end), or from ``examples``."""
    if labelled is None:
        return train(examples())
    rows = labelled.select("text", "spans").limit(MAX_EXAMPLES + 1).collect()
    return train([(r["text"], [tuple(s) for s in r["spans"] or []]) for r in rows])


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
_FOUND_ARROW = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())]
)
RUN_CHARS = 2_000_000


def find(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """One row per document, as in ``FOUND``."""
    model = trained(labelled)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for got in batches:
            ids, texts = got["doc_id"].to_pylist(), got["text"].to_pylist()
            for begin, end in runs(texts, RUN_CHARS):
                spans = spans_of(texts[begin:end], model, cache)
                counts = {
                    f"n_{name}": [sum(x[1] == k for x in b) for b, _ in spans] for k, name in enumerate(KINDS)
                }
                yield batch(
                    _FOUND_ARROW,
                    doc_id=ids[begin:end],
                    base_sha256=[hashlib.sha256(written(b).encode()).hexdigest() for b, _ in spans],
                    spans=[written(a) for _, a in spans],
                    **counts,
                )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text")).mapInArrow(given_back(search), FOUND)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The columns of `documents`, with personal data replaced and n_chars counted again.

    Texts without personal data, null ones too, stay as they are, and so does their n_chars.
    """
    model = trained(labelled)
    frame = docs.select(*DOCUMENT_COLUMNS)
    n = DOCUMENT_COLUMNS.index("text"), DOCUMENT_COLUMNS.index("n_chars")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for got in (some for whole in batches for some in cuts(whole, "text", RUN_CHARS)):
            texts = got["text"].to_pylist()
            sizes = got["n_chars"].to_pylist()
            given = [t or "" for t in texts]
            for begin, end in runs(given, RUN_CHARS):
                for i, (_, spans) in enumerate(spans_of(given[begin:end], model, cache), begin):
                    if spans:
                        texts[i] = redacted(given[i], spans)
                        sizes[i] = len(texts[i])
            out = got.set_column(n[0], "text", pa.array(texts, got.schema.field("text").type))
            yield out.set_column(n[1], "n_chars", pa.array(sizes, got.schema.field("n_chars").type))

    return frame.mapInArrow(given_back(replace), frame.schema)
