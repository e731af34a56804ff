"""Secret scan: base patterns, and a character network over every candidate and its surroundings.

Candidates are all runs of [A-Za-z0-9+/_.=-] with twelve characters or more. The network (embedding,
convolution, pooling, logistic output, all in numpy) reads WITHIN characters of a candidate, those before and those
after; over a longer candidate this window slides to its end, and the largest output counts. It is trained on
the labelled findings of all documents: spans of the base patterns against candidates that no pattern takes, with and
without digits; half of the time the text before is blanked, so that it also learns what a secret itself looks like. A
quarter of the findings is kept out to calibrate the output (a scale and a shift) and to choose the threshold: the
highest at which the wanted recall of held-out secrets is still reached. What it reaches there is kept as `recall`.

Findings are dealt by hash into shares. A task learns from the first; from its weights the tasks of all other shares go
on side by side, each through the whole of its own, and the mean of their weights is the network. Equal findings are
learned from once, and count each time they occur in calibration and threshold.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asfalto.llm.batches import free_name, text_parts, texts_of
from asfalto.operators.layout import stage

# The base patterns, their order and least lengths.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# Quick tests of whole batches; each takes in every text that its pattern can match.
_MAY_ASSIGN = r"""(?i)(passw(or)?d|secret|token|api_?key)["']? *[:=]"""
_MAY_ACCESS, _MAY_HEX, _MAY_RUN = "AKIA[A-Z0-9]", "[0-9a-f]{16}", "[A-Za-z0-9+/_.=-]{12}"

RUN = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
_DIGIT = re.compile(r"[0-9]")

BEFORE, WITHIN, AFTER = 24, 40, 8
STEP = WITHIN // 2  # by which the window slides over longer candidates
LENGTH = BEFORE + WITHIN + AFTER
SYMBOLS = 98  # padding, printable ASCII and line break, anything else

SHARE_FINDINGS = 100_000  # that a task learns from, about
BATCH, LEAST_OF_KIND, STEPS = 64, 16, 400  # findings of a step, of each kind at least; steps of a task at least
GRID = 256  # cells per unit in which held-out logits are counted
MOST_LOGIT = 64
RECALL = 0.98
LEAST_FINDINGS = 16

_PLAIN, _SECRET, _NUMBERED = 0, 1, 2  # kinds of findings
WEIGHTS = ("embedding", "filters", "filter_bias", "out", "out_bias")
Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str, assign: bool = True, access: bool = True, hexadecimal: bool = True) -> list[Span]:
    """Spans of the base patterns, by start and then kind."""
    found: list[Span] = []
    if assign:
        found += [
            (m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_LEAST
        ]
    if access:
        found += [
            (m.start(), 1, m.end()) for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LEAST
        ]
    if hexadecimal:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def other_candidates(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Runs that touch no span of `taken`."""
    runs = [m.span() for m in RUN.finditer(text)]
    if not taken:
        return runs
    starts = np.array([s for s, _, _ in taken])
    reach = np.maximum.accumulate([e for _, _, e in taken])
    return [
        (a, b) for a, b in runs
        if not (n := int(np.searchsorted(starts, b))) or reach[n - 1] <= a
    ]


def _surroundings(text: str, start: int, end: int) -> str:
    """The characters around and in a candidate, LENGTH of them."""
    return (
        text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0")
        + text[start : min(end, start + WITHIN)].ljust(WITHIN, "\0")
        + text[end : end + AFTER].ljust(AFTER, "\0")
    )


def _coded(surroundings: list[str]) -> np.ndarray:
    """Codes of their characters, a row for each."""
    codes = np.frombuffer("".join(surroundings).encode("utf-32-le"), "<u4").reshape(-1, LENGTH)
    printable = (codes >= 32) & (codes < 127)
    return np.where(printable, codes - 31, np.where(codes == 0, 0, np.where(codes == 10, 96, 97))).astype(
        np.uint8
    )


def window(text: str, start: int, end: int) -> np.ndarray:
    """Codes of the characters around and in a candidate, and where it lies."""
    return _coded([_surroundings(text, start, end)])[0]


def _slid(text: str, start: int, end: int) -> Iterator[str]:
    """Surroundings over the whole of a candidate, the last at its end."""
    last = max(start, end - WITHIN)
    for at in range(start, last, STEP):
        yield _surroundings(text, at, at + WITHIN)
    yield _surroundings(text, last, end)


def windows(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """Windows over the whole of a candidate, the last one at its end."""
    yield from _coded([*_slid(text, start, end)])


def render(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


@dataclass
class Network:
    embedding: np.ndarray  # symbols x width
    filters: np.ndarray  # (taps * (width + 1)) x filters; the last channel marks the candidate
    filter_bias: np.ndarray
    out: np.ndarray  # 2 * filters: largest and mean response
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5
    recall: float = 0.0  # of held-out secrets at the threshold

    TAPS = 5

    @classmethod
    def start(cls, seed: int, width: int = 8, filters: int = 24) -> Network:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, s: rng.normal(0, s, shape).astype(np.float32)
        n = cls.TAPS * (width + 1)
        return cls(
            normal(SYMBOLS, width, s=0.5), normal(n, filters, s=n**-0.5), np.zeros(filters, np.float32),
            normal(2 * filters, s=(2 * filters) ** -0.5), np.zeros(1, np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in WEIGHTS]

    def _forward(self, codes: np.ndarray):
        inside = np.zeros((*codes.shape, 1), np.float32)
        inside[:, BEFORE : BEFORE + WITHIN] = 1
        rows = np.concatenate([self.embedding[codes], inside], axis=2)
        rows[..., -1:] *= (codes > 0)[..., None]
        taps = np.lib.stride_tricks.sliding_window_view(rows, self.TAPS, axis=1)
        columns = taps.transpose(0, 1, 3, 2).reshape(len(codes), -1, self.filters.shape[0])
        responses = np.maximum(columns @ self.filters + self.filter_bias, 0)
        pooled = np.concatenate([responses.max(axis=1), responses.mean(axis=1)], axis=1)
        return columns, responses, pooled, pooled @ self.out + self.out_bias

    def logits(self, codes: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[i : i + 256])[3] for i in range(0, len(codes), 256)]
        return np.concatenate([np.zeros(0, np.float32), *parts])

    def gradients(
        self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None
    ) -> list[np.ndarray]:
        """Of the mean loss, or of the sum of losses by `weights`."""
        columns, responses, pooled, logits = self._forward(codes)
        d = (_sigmoid(logits) - labels) * (1 / len(labels) if weights is None else weights)
        d = d.astype(np.float32)
        back = d[:, None] * self.out
        n = self.filters.shape[1]
        d_responses = np.repeat(back[:, None, n:] / responses.shape[1], responses.shape[1], axis=1)
        top = responses.argmax(axis=1)
        rows, kinds = np.arange(len(codes))[:, None], np.arange(n)[None]
        d_responses[rows, top, kinds] += back[:, :n]
        d_responses *= responses > 0
        flat = d_responses.reshape(-1, n)
        width = self.embedding.shape[1]
        of_embedding = self.filters.reshape(self.TAPS, width + 1, n)[:, :-1].reshape(-1, n)
        d_columns = (flat @ of_embedding.T).reshape(len(codes), -1, self.TAPS, width)
        d_rows = np.zeros((*codes.shape, width), np.float32)
        for tap in range(self.TAPS):
            d_rows[:, tap : tap + d_columns.shape[1]] += d_columns[:, :, tap]
        by_symbol = [
            np.bincount(codes.ravel(), d_rows[..., k].ravel(), SYMBOLS) for k in range(width)
        ]
        d_embedding = np.stack(by_symbol, axis=1).astype(np.float32)
        return [
            d_embedding, columns.reshape(len(flat), -1).T @ flat, flat.sum(axis=0),
            pooled.T @ d, d.sum(keepdims=True),
        ]

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(codes).astype(np.float64) + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _calibrate(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Scale and shift that fit the logits to held-out labels, slightly smoothed (Platt); each counts so often."""
    total, positives = counts.sum(), (counts * labels).sum()
    target = np.where(labels > 0, (positives + 1) / (positives + 2), 1 / (total - positives + 2))
    mean = lambda x: (counts * x).sum() / total
    # steps by an upper bound of the curvature never overshoot, however far apart the labels lie
    bound = 0.25 * np.array([[mean(logits**2), mean(logits)], [mean(logits), 1.0]]) + np.diag([1e-3, 1e-6])
    scale, shift = 1.0, 0.0
    for _ in range(500):
        error = _sigmoid(scale * logits + shift) - target
        step = np.linalg.solve(bound, [mean(error * logits) + 1e-3 * (scale - 1), mean(error)])
        scale, shift = scale - step[0], shift - step[1]
    return float(max(scale, 1e-3)), float(shift)


def _judge_by(network: Network, cells: np.ndarray, labels: np.ndarray, counts: np.ndarray, recall: float) -> None:
    """Calibrate, and set the threshold, from how many held-out findings lie in each cell of the logits."""
    if not len(cells):
        return
    logits = cells.astype(np.float64) / GRID
    network.scale, network.shift = _calibrate(logits, labels, counts)
    order = np.argsort(-cells[labels == 1], kind="stable")
    found = np.cumsum(counts[labels == 1][order])
    if len(found):
        # the highest cell down to which no more than 1 - recall of them are left out
        last = int(np.searchsorted(found, recall * found[-1]))
        lowest = cells[labels == 1][order][last] / GRID
        network.threshold = float(_sigmoid(network.scale * lowest + network.shift))
        network.recall = float(found[last] / found[-1])


def _cells(network: Network, codes: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(network.logits(codes).astype(np.float64), -MOST_LOGIT, MOST_LOGIT) * GRID).astype(np.int64)


def _learn(network: Network, codes: np.ndarray, kinds: np.ndarray, seed: int) -> None:
    """Go through all findings in random order, as often as it takes for STEPS; in place.

    A step has findings of each kind, in proportion but at least a few; secrets weigh as much as all others, and those
    with and without digits alike.
    """
    rng = np.random.default_rng(seed)
    of_kind = [places for k in (_SECRET, _NUMBERED, _PLAIN) if len(places := np.flatnonzero(kinds == k))]
    sizes = [max(LEAST_OF_KIND, round(BATCH * len(places) / len(kinds))) for places in of_kind]
    steps = max(STEPS, *(-(-len(places) // size) for places, size in zip(of_kind, sizes)))
    turns = [
        np.concatenate([rng.permutation(places) for _ in range(-(-steps * size // len(places)))])
        for places, size in zip(of_kind, sizes)
    ]
    others = sum(kinds[places[0]] != _SECRET for places in of_kind)
    weights = np.concatenate([
        np.full(size, (0.5 if kinds[places[0]] == _SECRET else 0.5 / others) / size)
        for places, size in zip(of_kind, sizes)
    ])
    first = [np.zeros_like(w) for w in network.weights]
    second = [np.zeros_like(w) for w in network.weights]
    for step in range(steps):
        chosen = np.concatenate([t[step * size : (step + 1) * size] for t, size in zip(turns, sizes)])
        seen = codes[chosen].copy()
        seen[rng.random(len(seen)) < 0.5, :BEFORE] = 0
        labels = (kinds[chosen] == _SECRET).astype(np.float32)
        for w, g, m, v in zip(network.weights, network.gradients(seen, labels, weights), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= 0.004 * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.999 ** (step + 1))) + 1e-8)


def fit(codes: np.ndarray, labels: np.ndarray, recall: float = RECALL, seed: int = 0) -> Network | None:
    """A network from findings in memory; None where there are too few of either label to learn from."""
    if min((labels == 1).sum(), (labels == 0).sum()) < LEAST_FINDINGS:
        return None
    order = np.random.default_rng(seed).permutation(len(labels))
    kept_out, used = order[: len(order) // 4], order[len(order) // 4 :]
    network = Network.start(seed)
    _learn(network, codes[used], np.where(labels[used] == 1, _SECRET, _PLAIN), seed)
    cells = _cells(network, codes[kept_out])
    _judge_by(network, cells, labels[kept_out], np.ones(len(cells)), recall)
    return network


def _flags(texts: pa.Array) -> list[np.ndarray]:
    return [
        pc.match_substring_regex(texts, pattern).to_numpy(False)
        for pattern in (_MAY_ASSIGN, _MAY_ACCESS, _MAY_HEX, _MAY_RUN)
    ]


def findings(docs: DataFrame) -> DataFrame:
    """(codes, kind, n, kept_out): windows of the findings in all documents, how often each occurs, and which are held out."""
    texts = docs.select(F.lit(0).alias("doc_id"), F.col("text").alias("text"))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches):
            texts = texts_of(part)
            flags = _flags(texts)
            codes, kinds = [], []
            for n in np.flatnonzero(np.logical_or.reduce(flags)):
                text = texts[int(n)].as_py()
                spans = base_spans(text, *(bool(f[n]) for f in flags[:3]))
                others = other_candidates(text, spans) if flags[3][n] else []
                for kind, a, b in [(_SECRET, a, b) for a, _, b in spans] + [
                    (_NUMBERED if _DIGIT.search(text, a, b) else _PLAIN, a, b) for a, b in others
                ]:
                    seen = [*_slid(text, a, b)]
                    codes += seen
                    kinds += [kind] * len(seen)
            flat = pa.py_buffer(_coded(codes).tobytes())
            rows = pa.Array.from_buffers(pa.binary(LENGTH), len(codes), [None, flat]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([rows, pa.array(kinds, pa.int32())], names=["codes", "kind"])

    found = texts.mapInArrow(labelled, "codes binary, kind int").groupBy("codes", "kind").agg(
        F.count(F.lit(1)).alias("n"))
    kept_out = F.pmod(F.xxhash64("codes", F.lit(8)), F.lit(4)) == 0
    return stage(found.withColumn("kept_out", kept_out), "findings")


def _matrix(codes: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, LENGTH)


def _learned(used: DataFrame, network: Network, shares: int) -> Network:
    """The mean of the networks that so many shares of the findings make of this one, by their size."""

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [(_matrix(b.column("codes")), b.column("kind").to_numpy(False)) for b in batches if b.num_rows]
        if not seen:
            return
        codes, kinds = (np.concatenate(parts) for parts in zip(*seen))
        own = replace(network, **{k: w.copy() for k, w in zip(WEIGHTS, network.weights)})
        _learn(own, codes, kinds, TaskContext.get().partitionId())
        flat = np.concatenate([w.ravel() for w in own.weights]).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()]), pa.array([len(kinds)]), pa.array([flat], pa.binary())],
            names=["share", "n", "weights"],
        )

    dealt = used.repartition(shares, F.xxhash64("codes", F.lit(3))).sortWithinPartitions("codes", "kind")
    # a few KB of weights per share
    rows = sorted(dealt.mapInArrow(learned, "share long, n long, weights binary").collect())
    if not rows:
        return network
    total = sum(r["n"] for r in rows)
    mean = sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["n"] / total) for r in rows)
    cuts = np.cumsum([w.size for w in network.weights])[:-1]
    parts = [p.reshape(w.shape).astype(np.float32) for p, w in zip(np.split(mean, cuts), network.weights)]
    return replace(network, **dict(zip(WEIGHTS, parts)))


def train(docs: DataFrame, recall: float = RECALL, share: int = SHARE_FINDINGS) -> Network | None:
    """A network from the findings of all documents; None where there are too few of either label to learn from."""
    found = findings(docs)
    secret = (F.col("kind") == _SECRET).cast("int")
    sums = found.groupBy(secret.alias("secret")).agg(
        F.sum("n").alias("n"), F.count_if(~F.col("kept_out")).alias("used")).collect()
    if len(sums) < 2 or min(r["n"] for r in sums) < LEAST_FINDINGS or not all(r["used"] for r in sums):
        return None
    shares = -(-sum(r["used"] for r in sums) // share)
    first = F.pmod(F.xxhash64("codes", F.lit(5)), F.lit(shares)) == 0
    used = found.where(~F.col("kept_out")).select("codes", "kind")
    network = _learned(used.where(first), Network.start(0), 1)
    if shares > 1:
        network = _learned(used.where(~first), network, shares - 1)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = _cells(network, _matrix(batch.column("codes")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("secret"), batch.column("n"), pa.array(cells)], names=["secret", "n", "cell"])

    # a row per label and cell that occurs, whatever the number of findings
    held = found.where("kept_out").select("codes", secret.alias("secret"), "n")
    rows = held.mapInArrow(placed, "secret int, n long, cell long").groupBy("secret", "cell").agg(
        F.sum("n").alias("n")).orderBy("secret", "cell").collect()
    of = lambda name: np.array([r[name] for r in rows], np.int64)
    _judge_by(network, of("cell"), of("secret"), of("n"), recall)
    return network


class _Scanner:
    """Spans of whole texts; the network sees the candidates of many texts at once."""

    def __init__(self, network: Network | None):
        self._network = network

    def spans(self, texts: pa.Array) -> list[list[Span]]:
        flags = _flags(texts)
        found: list[list[Span]] = [[] for _ in range(len(texts))]
        owners, places, codes = [], [], []
        for n in np.flatnonzero(np.logical_or.reduce(flags)).tolist():
            text = texts[n].as_py()
            found[n] = base_spans(text, *(bool(f[n]) for f in flags[:3]))
            if self._network and flags[3][n]:
                for a, b in other_candidates(text, found[n]):
                    for seen in _slid(text, a, b):
                        owners.append(n)
                        places.append((a, b))
                        codes.append(seen)
                        if len(codes) == 4096:
                            self._judge(found, owners, places, codes)
        self._judge(found, owners, places, codes)
        # a candidate may be found by several of its windows
        return [sorted(set(f)) for f in found]

    def _judge(self, found, owners, places, codes) -> None:
        if codes:
            likely = self._network.probabilities(_coded(codes)) >= self._network.threshold
            for owner, (a, b), yes in zip(owners, places, likely):
                if yes:
                    found[owner].append((a, KINDS.index("model"), b))
        for held in (owners, places, codes):
            held.clear()


def scan(docs: DataFrame, network: Network | None) -> DataFrame:
    """Spans of every whole text; a null text is empty, and a document without spans has ''.

    Without a network (too little to learn from) only base spans are found.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(network)
        for part in text_parts(batches):
            spans = scanner.spans(texts_of(part))
            base = [[s for s in found if s[1] < 3] for found in spans]
            counts = [[sum(k == kind for _, k, _ in found) for found in base] for kind in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(render(b).encode()).hexdigest() for b in base]),
                    pa.array([render(s) for s in spans]),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")
    ).mapInArrow(
        scanned,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def blanked(text: str, spans: list[Span], mark: str) -> str:
    """The text with `mark` in place of each span; spans that overlap become one."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:]


def redact(
    docs: DataFrame, network: Network | None, mark: str = "[SECRET]", length_column: str | None = None
) -> DataFrame:
    """`docs` with every span in `text` replaced by `mark`; other texts, also null, stay as they are.

    Where a text changes, `length_column`, if there is one, gets its new number of characters.
    """

    @F.arrow_udf("string")
    def redacted(texts: pa.Array) -> pa.Array:
        scanner = _Scanner(network)
        out: list[str | None] = []
        for part in text_parts([pa.RecordBatch.from_arrays([texts], names=["text"])]):
            for raw, found in zip(part.column("text"), scanner.spans(texts_of(part))):
                text = raw.as_py()
                out.append(blanked(text, found, mark) if found else text)
        return pa.array(out, pa.string())

    if length_column is None or length_column not in docs.columns:
        return docs.withColumn("text", redacted(F.col("text")))
    name = free_name("_new_text", docs.columns)
    new = F.col(name)
    kind = docs.schema[length_column].dataType
    columns = {
        "text": new,
        length_column: F.when(new.eqNullSafe(F.col("text")), F.col(length_column))
        .otherwise(F.length(new)).cast(kind),
    }
    changed = docs.withColumn(name, redacted(F.col("text")))
    return changed.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
