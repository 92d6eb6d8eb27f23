"""Secret scans: patterns find the base spans; a character convolutional network judges every candidate.

Candidates are the base findings and all other runs of credential characters with a digit that no base span contains.
The network (embedding, convolution, ReLU, maximum and mean over positions, logistic output; all in numpy) reads a
candidate's characters and its surroundings; a candidate longer than its window in overlapping views, of which the
highest probability counts. It is trained on every distinct candidate of all documents: they are dealt over shards of
bounded size, in each round the shards train from the same weights and what they come to is averaged. As base findings
stay anyway, it has to learn secrets that no pattern names: each finding is also shown
without what its pattern knows it by (``password =``, ``AKIA``), and with its characters drawn anew from other alphabets
of credentials; against them stand the other candidates, and near misses made of the words around (numbers, dates,
slugs, identifiers). Its output is calibrated (Platt) on all findings kept apart. The threshold is the largest that keeps
the demanded recall on all findings of a kind that the network has not seen: for each kind, one is trained without it.
Candidates over the threshold become further spans of kind ``net``.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_texts
from .common import materialise
from .toxicity import logistic

KINDS = ("assign", "access", "hex", "net")
#: The base patterns and the lengths that a finding needs.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: A run of at least so many of these characters, one of them a digit, is a candidate.
LEAST_RUN = 12
_OUTSIDE = re.compile(r"[^A-Za-z0-9+/_=-]")
_DIGIT = re.compile(r"[0-9]")
#: Characters of the surroundings and of the candidate that the network reads at once.
BEFORE, INSIDE, AFTER = 24, 48, 8
#: Characters that two views of a longer candidate share.
OVERLAP = 8
WIDTH = BEFORE + INSIDE + AFTER
#: Candidates that a shard of training should hold, and how many of each label and kind it needs: rarer ones are in
#: several shards.
SHARD, NEEDED = 6_000, 250
#: Recall on kinds not seen in training that the threshold must keep; rounds of training, and steps in all of them, with all
#: kinds and without one. A shard takes more steps if it needs them to show every row.
RECALL = 0.95
ROUNDS, STEPS, FEWER_STEPS = 3, 300, 150
#: Logits are counted by such parts of 1, up to FAR; weights are summed by such parts, so that their order doesn't matter.
PARTS, FAR, FINE = 64, 40, 2**24
#: Alphabets of credentials, and the letters that words are made of where a window has none.
ALPHABETS = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789ABCDEF",
    "0123456789abcdef",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
)
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), end exclusive, in code points; sorted by start, then kind as in KINDS."""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def runs(text: str) -> list[tuple[int, int]]:
    """Whole runs of credential characters with a digit, LEAST_RUN characters or longer."""
    out, at = [], 0
    while m := _DIGIT.search(text, at):
        left = m.start()
        while left > at and not _OUTSIDE.match(text, left - 1):
            left -= 1
        right = m.end()
        end = _OUTSIDE.search(text, right)
        right = end.start() if end else len(text)
        if right - left >= LEAST_RUN:
            out.append((left, right))
        at = right
    return out


def inside(spans: list[tuple[int, int]], base: list[tuple[int, int, str]]) -> list[bool]:
    """Whether a base span contains each of ``spans`` (sorted, disjoint)."""
    out, k, reach = [], 0, -1
    for a, b in spans:  # of the base spans that begin at a or before only the farthest end counts
        while k < len(base) and base[k][0] <= a:
            reach = max(reach, base[k][1])
            k += 1
        out.append(b <= reach)
    return out


def around(text: str, a: int, b: int, cut: int | None = None) -> tuple[str, str, str]:
    """What the network learns from of a span: before it, of it (of a longer one the first characters and the last eight),
    and after it. With ``cut`` the span begins there and what is between ``a`` and ``cut`` isn't seen."""
    at = a if cut is None else cut
    body = text[at:b] if b - at <= INSIDE else text[at : at + INSIDE - 8] + text[b - 8 : b]
    return text[max(0, a - BEFORE) : a], body, text[b : b + AFTER]


def views(text: str, a: int, b: int) -> list[tuple[str, str, str]]:
    """What the network judges a span by: as it is, or a longer one in views of INSIDE characters that overlap by OVERLAP
    at least and cover all of it, besides the form that it learned from."""
    whole = around(text, a, b)
    if b - a <= INSIDE:
        return [whole]
    starts = [*range(a, b - INSIDE, INSIDE - OVERLAP), b - INSIDE]
    return [whole, *((whole[0], text[i : i + INSIDE], whole[2]) for i in starts)]


def window(before: str, body: str, after: str) -> np.ndarray:
    """Character classes, WIDTH of them: 0 pads, 1 is anything beyond ASCII."""
    out = np.zeros(WIDTH, np.int16)
    for at, part in ((BEFORE - len(before), before), (BEFORE, body), (BEFORE + INSIDE, after)):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        out[at : at + len(points)] = np.where(points < 128, points + 2, 1)
    return out


def windows(text: str, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[int]]:
    """The windows of all views of ``spans``, and how many each has."""
    seen = [views(text, *s) for s in spans]
    return np.array([window(*v) for of_span in seen for v in of_span], np.int16).reshape(-1, WIDTH), [len(v) for v in seen]


def unmarked(text: str, a: int, b: int, kind: str) -> int:
    """Where a base finding begins without what its pattern knows it by."""
    return ASSIGN.match(text, a, b).start(2) if kind == "assign" else a + 4 if kind == "access" else a


class Network:
    """A one-layer character CNN with its gradients, trained by Adam."""

    EMBEDDED, FILTERS, TAPS = 8, 24, 5

    def __init__(self, seed: int = 9, kind=np.float64):
        r = np.random.default_rng(seed)
        d = self.EMBEDDED + 1
        self.p = {
            "embed": r.normal(0, 0.3, (130, self.EMBEDDED)),
            "conv": r.normal(0, (2 / (d * self.TAPS)) ** 0.5, (d * self.TAPS, self.FILTERS)),
            "bias": np.zeros(self.FILTERS),
            "out": r.normal(0, 0.2, 2 * self.FILTERS),
            "base": np.zeros(1),
        }
        self.p = {k: a.astype(kind) for k, a in self.p.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.p.values()]).astype(np.float64)

    @classmethod
    def of(cls, flat: np.ndarray, kind=np.float64) -> Network:
        out, at = cls(kind=kind), 0
        for k, a in out.p.items():
            out.p[k] = np.asarray(flat[at : at + a.size], kind).reshape(a.shape)
            at += a.size
        return out

    def forward(self, x: np.ndarray):
        p, n = self.p, len(x)
        seen = np.zeros((n, WIDTH, self.EMBEDDED + 1), p["embed"].dtype)
        seen[..., :-1] = p["embed"][x] * (x > 0)[..., None]
        seen[:, BEFORE : BEFORE + INSIDE, -1] = x[:, BEFORE : BEFORE + INSIDE] > 0
        cols = np.lib.stride_tricks.sliding_window_view(seen, self.TAPS, 1).transpose(0, 1, 3, 2).reshape(n, WIDTH - self.TAPS + 1, -1)
        act = np.maximum(cols @ p["conv"] + p["bias"], 0)
        pooled = np.concatenate([act.max(1), act.mean(1)], 1)
        return cols, act, pooled, pooled @ p["out"] + p["base"][0]

    def logits(self, x: np.ndarray, batch: int = 512) -> np.ndarray:
        return np.concatenate([self.forward(x[i : i + batch])[-1] for i in range(0, len(x), batch)]) if len(x) else np.zeros(0)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        cols, act, pooled, z = self.forward(x)
        dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(z.dtype)
        g = {"out": pooled.T @ dz, "base": dz.sum(keepdims=True)}
        dpool = dz[:, None] * p["out"]
        k = self.FILTERS
        dact = np.broadcast_to(dpool[:, None, k:] / act.shape[1], act.shape).copy()
        top = act.argmax(1)
        dact[np.arange(n)[:, None], top, np.arange(k)[None]] += dpool[:, :k]  # no place twice
        dact *= act > 0
        flat = dact.reshape(-1, k)
        g["conv"], g["bias"] = cols.reshape(len(flat), -1).T @ flat, flat.sum(0)
        dcols = (dact @ p["conv"].T).reshape(n, act.shape[1], self.TAPS, -1)
        dseen = np.zeros((n, WIDTH, self.EMBEDDED + 1), z.dtype)
        for t in range(self.TAPS):
            dseen[:, t : t + act.shape[1]] += dcols[:, :, t]
        at = x.ravel()
        g["embed"] = np.stack([np.bincount(at, dseen[..., e].ravel(), len(p["embed"])) for e in range(self.EMBEDDED)], 1).astype(z.dtype)
        g["embed"][0] = 0  # padding has no embedding
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 96, rate: float = 0.01, seed: int = 9) -> None:
        """Each step shows as many rows of one class as of the other; a class comes whole before any row of it comes again."""
        r = np.random.default_rng(seed)
        shown = []
        for c in (0, 1):
            rows = np.flatnonzero(y == c)
            turns = -(-steps * (batch // 2) // len(rows))
            shown.append(np.concatenate([r.permutation(rows) for _ in range(turns)]))
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for t in range(1, steps + 1):
            pick = np.concatenate([rows[(t - 1) * (batch // 2) : t * (batch // 2)] for rows in shown])
            for k, g in self.gradients(x[pick], y[pick]).items():
                g = g + 1e-4 * self.p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / ((v[k] / (1 - 0.999**t)) ** 0.5 + 1e-8)


class Scanner(NamedTuple):
    network: Network | None
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.zeros(len(x))
        return self.of_logits(self.network.logits(x))

    def of_logits(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -40, 40)))


def scan(texts: list[str | None], scanner: Scanner) -> list[list[tuple[int, int, str, float]]]:
    """All spans of each text with the network's probability: base ones always, others over the threshold."""
    found, rows, counts, at = [], [], [], []
    for i, text in enumerate(texts):
        text = text or ""
        base = base_spans(text)
        more = runs(text)
        more = [s for s, known in zip(more, inside(more, base), strict=True) if not known]
        candidates = [*base, *((a, b, "net") for a, b in more)]
        found.append(candidates)
        if candidates:
            x, n = windows(text, [c[:2] for c in candidates])
            rows.append(x)
            counts += n
            at.append(i)
    p = np.zeros(0)
    if rows:  # a candidate is what the most suspicious of its views is
        p = np.maximum.reduceat(scanner.probabilities(np.concatenate(rows)), np.cumsum([0, *counts[:-1]]))
    out: list[list] = [[] for _ in texts]
    k = 0
    for i in at:
        scored = [(*c, float(q)) for c, q in zip(found[i], p[k : k + len(found[i])], strict=True)]
        k += len(found[i])
        kept = [s for s in scored if s[2] != "net" or (scanner.network is not None and s[3] >= scanner.threshold)]
        out[i] = sorted(kept, key=lambda s: (s[0], KINDS.index(s[2])))
    return out


class Smallest:
    """The ``most`` smallest of all distinct keys that were offered."""

    def __init__(self, most: int):
        self.most, self.heap, self.kept = most, [], set()

    def offer(self, key: tuple[int, int]) -> bool:
        """Whether ``key`` is new and among the smallest so far."""
        if key in self.kept or (len(self.heap) >= self.most and key >= (-self.heap[0][0], -self.heap[0][1])):
            return False
        self.kept.add(key)
        heapq.heappush(self.heap, (-key[0], -key[1]))
        if len(self.heap) > self.most:
            a, b = heapq.heappop(self.heap)
            self.kept.remove((-a, -b))
        return True


AS_IS, UNMARKED, OTHER = 1, 2, 0


def _candidates():
    """Hash, label, kind, fold and window of a text's candidates. Findings come as they are and without their marks."""

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = set()
        for text in part.column("text").to_pylist():
            base = base_spans(text)
            more = runs(text)
            seen = [(AS_IS, KINDS.index(k), around(text, a, b)) for a, b, k in base]
            seen += [(UNMARKED, KINDS.index(k), around(text, a, b, unmarked(text, a, b, k))) for a, b, k in base]
            seen += [(OTHER, len(KINDS), around(text, *s)) for s, known in zip(more, inside(more, base), strict=True) if not known]
            fold = hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()[0] % 4 if seen else 0  # a text's candidates stay together
            for label, kind, parts in seen:
                codes = window(*parts).astype(np.uint8).tobytes()
                mark = int.from_bytes(hashlib.blake2b(codes, digest_size=8).digest(), "big", signed=True)
                rows.add((mark, label, kind, fold, codes))
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
        columns = zip(*rows, strict=True) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["_hash", "label", "kind", "fold", "window"])

    return step


def _words(x: np.ndarray) -> np.ndarray:
    """Words of the surroundings in ``x``."""
    text = " ".join("".join(chr(c - 2) if c > 1 else " " for c in np.r_[row[:BEFORE], row[BEFORE + INSIDE :]]) for row in x.tolist())
    return np.array(re.findall(r"[A-Za-z]{2,}", text) or [LETTERS[:5], LETTERS[7:12]])


def _secret(r: np.random.Generator) -> str:
    """A string as credentials have them: characters at random, some with a prefix, some in groups."""
    letters = ALPHABETS[r.integers(len(ALPHABETS))]
    body = "".join(r.choice(list(letters), int(r.integers(12, 45))))
    shape = r.random()
    if shape < 0.3:
        body = "".join(r.choice(list(LETTERS), int(r.integers(2, 5)))) + r.choice(["_", "-"]) + body
    elif shape < 0.45:
        body = "-".join(body[i : i + 8] for i in range(0, len(body), 8))
    return body if _DIGIT.search(body) else body + str(r.integers(10))


def _near_miss(r: np.random.Generator, words: np.ndarray) -> str:
    """A run with a digit that is no secret: a number, a date, a slug, an identifier or a path."""
    number = lambda n: "".join(r.choice(list("0123456789"), n))
    some = [str(w) for w in r.choice(words, int(r.integers(2, 5)))]
    shape = r.integers(6)
    if shape == 0:
        return number(int(r.integers(12, 24)))
    if shape == 1:
        return f"20{number(2)}-{r.integers(1, 13):02}-{r.integers(1, 29):02}T{number(2)}-{number(2)}"
    if shape == 2:
        return "-".join(number(int(r.integers(2, 5))) for _ in range(int(r.integers(4, 7))))
    if shape == 3:
        return r.choice(["-", "_"]).join([*some, number(int(r.integers(1, 5)))])
    if shape == 4:
        return "".join(w.capitalize() for w in some) + number(int(r.integers(1, 4)))
    return "/".join([*some, number(int(r.integers(1, 5)))])


def _redrawn(x: np.ndarray, r: np.random.Generator, make) -> np.ndarray:
    """``x`` with other strings in their surroundings."""
    out = x.copy()
    for row in out:
        body = make().ljust(LEAST_RUN, "0")
        row[BEFORE : BEFORE + INSIDE] = window("", around(body, 0, len(body))[1], "")[BEFORE : BEFORE + INSIDE]
    return out


#: What a row of a shard is for: training, calibration (of findings as they are found, and of all others), or as a finding
#: of the kind that the network hasn't seen.
TRAIN, HELD, HELD_BARE, UNSEEN = range(4)


def _shard(nets: list[int]):
    """A function for ``applyInArrow``: what each network (the kind that it doesn't see, -1 for none) has to learn from a
    shard's candidates. Copies of rare candidates are for training only."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("label", "kind", "fold", "window", "copy")])
        label, kind, fold, copy, shard = (table.column(c).to_numpy() for c in ("label", "kind", "fold", "copy", "shard"))
        x = np.frombuffer(b"".join(table.column("window").to_pylist()), np.uint8).reshape(len(label), WIDTH).astype(np.int16)
        r = np.random.default_rng([9, int(shard[0])])
        parts = []
        for held in (False, True):
            mine = (fold == 3) & (copy == 0) if held else fold != 3
            bare, other = np.flatnonzero(mine & (label == UNMARKED)), np.flatnonzero(mine & (label == OTHER))
            both = np.concatenate([bare, other])
            words = _words(x[both])
            role = HELD if held else TRAIN
            if not held:
                as_is = np.flatnonzero(mine & (label == AS_IS))
                parts.append((x[as_is], kind[as_is], 1, role))
            parts.append((x[bare], kind[bare], 1, HELD_BARE if held else TRAIN))
            parts.append((_redrawn(x[bare], r, lambda: _secret(r)), kind[bare], 1, role))
            parts.append((x[other], kind[other], 0, role))
            parts += [(_redrawn(x[both], r, lambda: _near_miss(r, words)), kind[both], 0, role) for _ in range(2)]  # noqa: B023
        every = np.concatenate([p[0] for p in parts]).astype(np.uint8)
        kinds = np.concatenate([p[1] for p in parts])
        y, role = (np.repeat(np.array([p[i] for p in parts], np.uint8), [len(p[0]) for p in parts]) for i in (2, 3))
        unseen = (label == UNMARKED) & (copy == 0)
        rows = []
        for net in nets:
            new = unseen & (kind == net)
            rows.append((
                int(shard[0]), net,
                every[kinds != net].tobytes() + x[new].astype(np.uint8).tobytes(),
                y[kinds != net].tobytes() + bytes([1]) * int(new.sum()),
                role[kinds != net].tobytes() + bytes([UNSEEN]) * int(new.sum()),
            ))
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["shard", "net", "x", "y", "role"])

    return run


def deal(found: DataFrame, counts: dict[tuple[int, int], int]) -> DataFrame:
    """``found`` with the shard of each candidate. ``counts`` are those of each label and kind: where they don't give every
    shard NEEDED, the candidates go to several shards, numbered by ``copy``."""
    shards = max(1, math.ceil(sum(counts.values()) / SHARD))
    copies = F.lit(1)
    for (label, kind), n in counts.items():
        copies = F.when((F.col("label") == label) & (F.col("kind") == kind), min(shards, math.ceil(NEEDED * shards / n))).otherwise(copies)
    dealt = found.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.withColumn("shard", F.pmod(F.col("_hash") % shards + F.col("copy"), F.lit(shards)).cast("int"))


def _shard_rows(batch: pa.RecordBatch):
    for shard, net, x, y, role in zip(*(batch.column(c).to_pylist() for c in ("shard", "net", "x", "y", "role")), strict=True):
        yield shard, net, np.frombuffer(x, np.uint8).reshape(-1, WIDTH), np.frombuffer(y, np.uint8), np.frombuffer(role, np.uint8)


def _round(weights: dict[int, np.ndarray], turn: int):
    """A function for ``mapInArrow``: the weights that each shard's networks come to, and how many rows they learned from."""

    def run(batches):
        for batch in batches:
            for shard, net, x, y, role in _shard_rows(batch):
                x, y = x[role == TRAIN], y[role == TRAIN].astype(np.float32)
                if 0 < y.sum() < len(y):
                    network = Network.of(weights[net], np.float32)
                    larger = max(y.sum(), len(y) - y.sum()) / 48
                    network.train(x, y, math.ceil(max(STEPS if net < 0 else FEWER_STEPS, larger) / ROUNDS), seed=[9, shard, turn])
                    columns = [pa.array([net], pa.int32()), pa.array([len(y)], pa.int64()), pa.array([network.flat().tolist()], pa.list_(pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["net", "n", "w"])

    return run


def _logits(weights: dict[int, np.ndarray]):
    """A function for ``mapInArrow``: how many rows of each use and label have which logit, in PARTS of 1."""

    def run(batches):
        for batch in batches:
            for _, net, x, y, role in _shard_rows(batch):
                judged = role != TRAIN
                z = Network.of(weights[net]).logits(x[judged])
                keys = np.stack([role[judged], y[judged], np.floor(np.clip(z, -FAR, FAR) * PARTS).astype(np.int32)], 1)
                keys, n = np.unique(keys.astype(np.int32), axis=0, return_counts=True)
                columns = [np.full(len(n), net, np.int32), *keys.T, n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=["net", "role", "y", "z", "n"])

    return run


def fit(docs: DataFrame, recall: float = RECALL) -> Scanner:
    """Train on all distinct candidates of all documents.

    With fewer than 8 distinct findings to learn from, or fewer than 4 to calibrate on, in the whole table there is no
    network, and only base spans are found. The recall of the threshold is measured on all findings of the kinds that
    have 4 or more, each by a network trained without it; where there is one kind only, on the findings kept apart.

    To the driver come the weights, summed over shards, and counts by logit, whatever the number of candidates.
    """
    texts = docs.where("text IS NOT NULL").select(F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(map_texts(_candidates), "_hash long, label int, kind int, fold int, window binary").distinct()
    found = materialise(found, "findings")
    counts = {(r["label"], r["kind"], r["held"]): r["n"] for r in found.groupBy("label", "kind", (F.col("fold") == 3).alias("held")).agg(F.count("*").alias("n")).collect()}
    bare = lambda kinds, held: sum(counts.get((UNMARKED, k, held), 0) for k in kinds)
    kinds = range(len(KINDS))
    if bare(kinds, False) < 8 or bare(kinds, True) < 4:
        return Scanner(None)
    others = {k: [j for j in kinds if j != k] for k in kinds}
    nets = [-1, *(k for k in kinds if bare([k], False) + bare([k], True) >= 4 and bare(others[k], False) >= 4 and bare(others[k], True) >= 1)]
    both = {(label, kind): counts.get((label, kind, False), 0) + counts.get((label, kind, True), 0) for label, kind, _ in counts}
    n_shards = max(1, math.ceil(sum(both.values()) / SHARD))
    dealt = deal(found, both).repartition(n_shards, "shard")  # a number of its own, so that shards don't end in one task
    shards = dealt.groupBy("shard").applyInArrow(_shard(nets), "shard int, net int, x binary, y binary, role binary")
    shards = materialise(shards.repartition(n_shards * len(nets)), "shards")
    weights = dict.fromkeys(nets, Network().flat())
    for turn in range(ROUNDS):
        trained = shards.mapInArrow(_round(weights, turn), "net int, n long, w array<double>")
        fine = F.round(F.col("w") * FINE).cast("long")
        trained = trained.select("net", "n", F.posexplode("w").alias("at", "w")).groupBy("net", "at").agg(F.sum(F.col("n") * fine).alias("w"), F.sum("n").alias("n"))
        summed = trained.toArrow().sort_by([("net", "ascending"), ("at", "ascending")])
        net, w, n = (summed.column(c).to_numpy() for c in ("net", "w", "n"))
        weights |= {int(k): w[net == k] / FINE / n[net == k] for k in np.unique(net)}
    judged = shards.mapInArrow(_logits(weights), "net int, role int, y int, z int, n long").groupBy("net", "role", "y", "z").agg(F.sum("n").alias("n")).toArrow()
    net, role, y, z, n = (judged.column(c).to_numpy() for c in ("net", "role", "y", "z", "n"))

    def calibrated(k: int) -> Scanner:
        mine = (net == k) & np.isin(role, (HELD, HELD_BARE))
        shift, slope = logistic((z[mine, None] + 0.5) / PARTS, y[mine].astype(float), ridge=1e-3, weight=n[mine].astype(float))
        return Scanner(Network.of(weights[k]), float(slope), float(shift))

    def least(k: int, of: int) -> tuple[np.ndarray, np.ndarray]:
        """The least probability in each part of the logits, and how many findings are there."""
        scanner, mine = calibrated(k), (net == k) & (role == of)
        return np.minimum(*(scanner.of_logits((z[mine] + edge) / PARTS) for edge in (0, 1))), n[mine]

    parts = [least(k, UNSEEN) for k in nets[1:]] or [least(-1, HELD_BARE)]
    p, n_of = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(p)
    at = np.searchsorted(np.cumsum(n_of[order]), int(np.floor((1 - recall) * n_of.sum())), "right")
    return calibrated(-1)._replace(threshold=float(p[order][at]))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def find_secrets(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, probability), sorted by start and kind, for every row of ``docs``.

    Positions are code points, ends exclusive. A null or empty text has no spans. Rows don't depend on each other, so
    repeated rows or ids and empty tables need no rule; columns other than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner)

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            spans = [[{"kind": k, "start": a, "end": b, "probability": p} for a, b, k, p in s] for s in scan(part.column("text").to_pylist(), shared.value)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))
            return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(spans, kind)], names=["doc_id", "spans"])

        return step

    return _narrow(docs).mapInArrow(map_texts(make), "doc_id long, spans array<struct<kind string, start long, end long, probability double>>")


def digest_secrets(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """Counts and digests of ``find_secrets``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = find_secrets(docs, scanner)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "net")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("net"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, scanner: Scanner, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its texts masked (overlapping spans by one mask), and n_chars, if there, renewed.

    Null and empty texts stay as they are (n_chars null and 0). Rows don't depend on each other, so repeated rows and
    ids, ties and empty tables need no rule; all other columns come through, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    schema = docs.schema

    def make():
        def step(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = part.column("text").to_pylist()
            for i, spans in enumerate(scan(texts, shared.value)):
                out, at = [], 0
                for a, b, *_ in spans:
                    if a >= at:
                        out += [texts[i][at:a], mask]
                    at = max(at, b)
                if spans:
                    texts[i] = "".join(out) + texts[i][at:]
            columns = {n: part.column(n) for n in part.schema.names}
            columns["text"] = pa.array(texts, part.schema.field("text").type)
            if "n_chars" in columns:
                lengths = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                columns["n_chars"] = lengths.cast(part.schema.field("n_chars").type)
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return step

    return docs.mapInArrow(map_texts(make), schema)
