"""Personal data in texts: patterns, and a skip-chain conditional random field.

The patterns give the base spans (email, ip, card, phone).  Around them a field is laid over
each document: its nodes are the base spans, with their label known, and further
candidates (digit groups, and words that spell the name part of an email of the same text);
neighbouring nodes form the chain (unless they are similar), and skip edges join each node with the next one that
repeats it or resembles it (equal text, equal digits, equal last digits, equal name part)
however far away.  Sum-product message passing over this loopy graph makes the labels of
such nodes consistent; a candidate that ends up with a label other than "none" is added.
So a number that is written once with its country code and later without it is found both
times.

The weights are learned from all documents, where base spans are the labels and all other
candidates count as none.  Each task counts its nodes by features and label, and its edges
by their two labels; these few cells are all that the driver sees.  Label weights of the
features come from a logistic regression on the counted nodes, chain and skip weights from
how much more often joined nodes agree than nodes paired at random.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stmtscope.llm.scratch import share, shared_value

# Kinds in the order of the result, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NAME_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

PRIOR = {"chain": 1.0, "skip": 64.0}  # odds of agreement against chance, worth one edge
# A number in groups of three, three and four digits, perhaps with a country code, or any
# seven digits and more; not inside a word.
DIGIT_GROUP = re.compile(
    r"(?<![0-9A-Za-z+])(?:\+?(?:[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}"
    r"|[0-9](?:[\x20-]?[0-9]){6,})(?![0-9A-Za-z])"
)
WORD = re.compile(r"[A-Za-z0-9._%+-]+")
TAIL = 7  # equal last digits that make two numbers similar
PASSES = 12
CAUTION = 3.0  # added to the score of "none" for every candidate
STEPS, RATE = 400, 0.5
TEXTS_AT_ONCE = 512

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Pattern matches of each kind, leftmost first, without those that fail its test."""
    found: list[Span] = []
    end = 0
    for match in DOMAIN.finditer(text) if "@" in text else ():
        start = match.start()
        while start > end and text[start - 1] in NAME_CHARACTERS:
            start -= 1
        if start < match.start():
            found.append((0, start, match.end()))
            end = match.end()
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in match[0].split(".")):
            found.append((1, match.start(), match.end()))
    for match in CARD.finditer(text):
        digits = digits_of(match[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((2, match.start(), match.end()))
    for match in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
            found.append((3, match.start(), match.end()))
    return found


@dataclass
class Graph:
    """Nodes of one document in text order; label -1 where it is not known."""

    spans: list[tuple[int, int]]
    label: np.ndarray
    features: np.ndarray
    chain: np.ndarray  # pairs of neighbouring nodes that are not similar
    skip: np.ndarray  # pairs of similar nodes


def node_features(text: str) -> list[float]:
    n = sum("0" <= c <= "9" for c in text)
    parts = text.split(".")
    return [
        1.0,
        float("@" in text),
        float(text.startswith("+")),
        float(len(parts) == 4 and all(p.isdecimal() and len(p) <= 3 for p in parts)),
        float(7 <= n <= 8),
        float(9 <= n <= 12),
        float(13 <= n <= 19 and luhn(digits_of(text))),
        float(13 <= n <= 19 and not luhn(digits_of(text))),
        float("(" in text),
        float("-" in text or " " in text),
        float(any(c.isalpha() for c in text)),
    ]


N_FEATURES = len(node_features(""))


def graph_of(text: str, base: list[Span], always: bool = False) -> Graph | None:
    """None if there is no candidate besides the base spans, unless ``always`` is set."""
    covered = sorted((a, b) for _, a, b in base)
    nodes = [(a, b, kind) for kind, a, b in base]
    names = {text[a:b].split("@")[0].lower() for kind, a, b in base if kind == 0}
    names = {n for n in names if len(n) >= 5 and not n.isalpha()}
    words = WORD.finditer(text) if names else ()
    more = [m.span() for m in words if m[0].strip(".").lower() in names]
    more += [m.span() for m in DIGIT_GROUP.finditer(text)]
    i = 0
    for a, b in sorted(set(more)):
        while i < len(covered) and covered[i][1] <= a:
            i += 1
        if (i == len(covered) or covered[i][0] >= b) and (not nodes or nodes[-1][2] != -1 or nodes[-1][1] <= a):
            nodes.append((a, b, -1))
    if len(nodes) == len(base) and not (always and nodes):
        return None
    nodes.sort()
    keys: dict[tuple[str, str], int] = {}
    skip = []
    for i, (a, b, kind) in enumerate(nodes):
        own = text[a:b].lower().strip(".")
        digits = digits_of(own)
        # A number's tail links it with shorter and longer ways of writing it.
        forms = [("text", own), ("name", own.split("@")[0])]
        if len(digits) >= TAIL and "@" not in own:
            forms += [("digits", digits), ("tail", digits[-10:] if len(digits) >= 10 else digits[-TAIL:])]
        for key in dict.fromkeys(forms):
            if key in keys and keys[key] != i:
                skip.append((keys[key], i))
            keys[key] = i
    similar = set(skip)
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if (i, i + 1) not in similar]
    return Graph(
        [(a, b) for a, b, _ in nodes],
        np.array([kind for _, _, kind in nodes]),
        np.array([node_features(text[a:b]) for a, b, _ in nodes]),
        np.array(chain, np.int64).reshape(-1, 2),
        np.array(sorted(similar), np.int64).reshape(-1, 2),
    )


@dataclass
class Field:
    """Weights; labels are the kinds and, last, none."""

    unary: np.ndarray  # N_FEATURES x labels
    chain: float  # score of two neighbours with equal labels
    skip: float  # score of two similar nodes with equal labels

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label probabilities of the nodes after loopy sum-product message passing."""
        n_labels = len(KINDS) + 1
        scores = graph.features @ self.unary
        scores[:, -1] += CAUTION
        known = graph.label >= 0
        scores[known] = -30.0
        scores[known, graph.label[known]] = 0.0
        edges = np.concatenate([graph.chain, graph.skip])
        weight = np.repeat([self.chain, self.skip], [len(graph.chain), len(graph.skip)])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        opposite = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        gain = np.expm1(np.concatenate([weight, weight]))[:, None]
        messages = np.zeros((len(source), n_labels))
        for _ in range(PASSES):
            belief = scores.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[opposite]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            # Equal labels score weight, different ones 0.
            new = np.log(out.sum(axis=1, keepdims=True) + gain * out)
            messages = 0.5 * messages + 0.5 * (new - new.mean(axis=1, keepdims=True))
        belief = scores.copy()
        np.add.at(belief, target, messages)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def added(self, graph: Graph) -> list[Span]:
        p = self.marginals(graph)
        best = p.argmax(axis=1)
        chosen = (graph.label < 0) & (best < len(KINDS)) & (p.max(axis=1) >= 0.5)
        return [(int(best[i]), *graph.spans[i]) for i in np.flatnonzero(chosen)]


Cell = tuple[str, int, int]  # "node", features as bits, label; or kind of edge, two labels


def cells_of(texts: Iterable[str]) -> Counter[Cell]:
    """Nodes by features and label, edges by their labels.  Skip edges count where both labels
    are known; candidates resembling a base span are what the field is to decide."""
    cells: Counter[Cell] = Counter()
    none = len(KINDS)
    bits = 1 << np.arange(N_FEATURES)
    for text in texts:
        graph = graph_of(text, base_spans(text), always=True)
        if graph is None:
            continue
        own = np.where(graph.label < 0, none, graph.label).tolist()
        masks = (graph.features.astype(np.int64) @ bits).tolist()
        cells.update(("node", mask, label) for mask, label in zip(masks, own))
        cells.update(("chain", own[i], own[j]) for i, j in graph.chain.tolist())
        cells.update(("skip", own[i], own[j]) for i, j in graph.skip.tolist() if own[i] < none and own[j] < none)
    return cells


def _edge_weight(kind: str, cells: dict[Cell, int]) -> float:
    """Log-odds that two joined nodes agree, less that of nodes paired at random."""
    counts = np.zeros((len(KINDS) + 1, len(KINDS) + 1))
    for (part, a, b), n in cells.items():
        if part == kind:
            counts[a, b] += n
    ends = counts.sum(axis=0) + counts.sum(axis=1) + 1.0
    chance = float(((ends / ends.sum()) ** 2).sum())
    equal = float(np.trace(counts))
    differ = float(counts.sum()) - equal
    return float(np.log((equal + PRIOR[kind] * chance) / (differ + 1 - chance)) - np.log(chance / (1 - chance)))


def fit(cells: dict[Cell, int]) -> Field:
    """The same weights in each run."""
    none = len(KINDS)
    nodes = np.array(
        [(mask, label, n) for (part, mask, label), n in sorted(cells.items()) if part == "node"], np.int64
    ).reshape(-1, 3)
    x = (nodes[:, :1] >> np.arange(N_FEATURES) & 1).astype(float)
    share_of = nodes[:, 2] / max(1, nodes[:, 2].sum())
    weights = np.zeros((N_FEATURES, none + 1))
    target = np.eye(none + 1)[nodes[:, 1]]
    for _ in range(STEPS if len(nodes) else 0):
        p = x @ weights
        p = np.exp(p - p.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weights += RATE * (x.T @ ((target - p) * share_of[:, None]) - 1e-3 * weights)
    return Field(weights, _edge_weight("chain", cells), _edge_weight("skip", cells))


def train(docs: DataFrame) -> Field:
    """From the counts of all of ``docs`` (text): at most one cell per set of features and label."""
    counted = docs.where(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(_count_cells, "part string, a int, b int, n long")
    cells = counted.groupBy("part", "a", "b").agg(F.sum("n").alias("n")).collect()
    return fit({(r.part, r.a, r.b): r.n for r in cells})


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells: Counter[Cell] = Counter()
    for batch in batches:
        cells.update(cells_of(text.as_py() for text in batch.column("text")))
    part, a, b = ([cell[i] for cell in cells] for i in range(3))
    columns = [pa.array(part, pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(cells.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["part", "a", "b", "n"])


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for kind, a, b in sorted(spans))


def _each_text(batches: Iterator[pa.RecordBatch], field: Field):
    """Slices of the batches with the base and all spans of each text."""
    for batch in batches:
        wanted = pc.fill_null(pc.match_substring_regex(batch.column("text"), "[0-9@]"), False).to_pylist()
        for begin in range(0, len(batch), TEXTS_AT_ONCE):
            part = batch.slice(begin, TEXTS_AT_ONCE)
            found = []
            for text, want in zip(part.column("text"), wanted[begin : begin + TEXTS_AT_ONCE]):
                base, every = [], []
                if want:
                    text = text.as_py()
                    base = base_spans(text)
                    graph = graph_of(text, base)
                    every = base + (field.added(graph) if graph is not None else [])
                found.append((base, every))
            yield part, found


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``; other columns are ignored) with n_email,
    n_ip, n_card, n_phone (base spans of each kind), base_sha256 and spans.

    Spans are written as kind:start:end in code points, end exclusive, ordered by kind and
    start.  A null or empty text has none.  Rows of equal text get equal results.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = share(docs.sparkSession, train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _each_text(batches, shared_value(shared)):
            counts = [[sum(s[0] == kind for s in base) for base, _ in found] for kind in range(len(KINDS))]
            digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            columns = [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts]]
            columns += [pa.array(digests, pa.string()), pa.array([written(s) for _, s in found], pa.string())]
            names = ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return docs.mapInArrow(run, f"doc_id long, {counts}, base_sha256 string, spans string")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, end = [], 0
    for a, b, kind in sorted((a, b, kind) for kind, a, b in spans):
        if a >= end:
            out += [text[end:a], f"[{KINDS[kind].upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns; personal data in ``text`` is replaced by its kind in
    brackets.  Texts without any, and nulls, stay as they are."""
    shared = share(docs.sparkSession, train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _each_text(batches, shared_value(shared)):
            at = part.schema.get_field_index("text")
            own = part.column("text")
            if any(every for _, every in found):
                texts = [
                    redacted(t.as_py(), every) if every else t.as_py() for t, (_, every) in zip(own, found)
                ]
                own = pa.array(texts, own.type)
            columns = [*part.columns[:at], own, *part.columns[at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)
