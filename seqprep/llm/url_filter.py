"""URL filters: a list of host and path rules, and gradient-boosted trees on lexical features for all other URLs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

TRAIN_URLS = 20_000  # labelled URLs that the trees are fitted on, at most
TREES = 40
DEPTH = 4
BINS = 32  # of a feature's values that splits are searched among
RATE = 0.2
PENALTY = 1.0  # on leaf weights
LEAST = 20  # URLs that a leaf holds, about: sums of the loss's second derivatives of LEAST / 4
PRIOR = 20.0  # URLs of the average kind that a suffix's share of blocked URLs starts with
FOLDS = 5  # of the sample; the trees learn from suffix statistics of the other folds, as for URLs not seen
BLOCKED = 0.5  # probability from which a URL is blocked
PIECE_BYTES = 1 << 18  # of a very long URL that are counted at a time
ROWS = 4096  # URLs worked on at a time

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# What the suffix statistics are taken over: ends of the host and of the path, and the path's first part.
SUFFIXES = {"top_label": r"([^.]*)$", "last_labels": r"([^.]*\.[^.]*)$", "path_end": r"(\.[^./]*)$", "directory": r"^(/[^/]*)/"}
FEATURES = (
    "url_length", "host_length", "path_length", "rest_length", "host_depth", "path_depth", "host_digits", "path_digits",
    "rest_digits", "host_entropy", "path_entropy", "host_hyphens", "path_hyphens", "parameters", "values", "percents",
    "fragment", "secure", *(f"{name}_{kind}" for name in SUFFIXES for kind in ("share", "count")),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    place = F.instr(url, "://")
    return F.when(place > 0, url.substr(place + 3, F.length(url))).otherwise(F.lit(""))


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``; written as host and path in one."""

    verdict: str
    text: str
    host: str = field(init=False)
    path: str = field(init=False)

    def __post_init__(self) -> None:
        cut = self.text.index("/")
        object.__setattr__(self, "host", self.text[:cut])
        object.__setattr__(self, "path", self.text[cut:])

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith(f".{self.host}")
        return own & path.startswith(self.path)


# The rules of the query.
RULES = (
    Rule(ALLOW, "com/"),
    Rule(BLOCK, "example.com/en/"),
    Rule(ALLOW, "www.example.com/en/"),
    Rule(BLOCK, "net/es/"),
    Rule(BLOCK, "net/fr/"),
)


def with_rules(urls: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule (text of the longest rule that fits, else null) and ruled (its verdict, else null).

    Of rules of one length the one with the longer host wins, then the first in the list. The rules are part of
    the query plan, so the list must be short.
    """
    parted = urls.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    ordered = sorted(rules, key=lambda rule: (-len(rule.text), -len(rule.host)))

    def first(value) -> Column:
        chain = None
        for rule in ordered:
            fits = rule.fits(F.col("host"), F.col("path"))
            chain = F.when(fits, value(rule)) if chain is None else chain.when(fits, value(rule))
        return F.lit(None).cast("string") if chain is None else chain

    return parted.withColumns({"rule": first(lambda rule: rule.text), "ruled": first(lambda rule: rule.verdict)})


def byte_counts(texts: pa.Array) -> np.ndarray:
    """Per text (null: empty) how often each byte occurs."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    counts = np.zeros(len(texts) * 256, np.int64)
    for begin in range(int(offsets[0]) if len(texts) else 0, int(offsets[-1]) if len(texts) else 0, PIECE_BYTES):
        end = min(begin + PIECE_BYTES, int(offsets[-1]))
        first = int(np.searchsorted(offsets, begin, side="right")) - 1
        last = int(np.searchsorted(offsets, end, side="left"))
        bounds = np.clip(offsets[first : last + 1], begin, end)
        rows = np.repeat(np.arange(last - first), np.diff(bounds))
        found = np.bincount(rows * 256 + data[begin:end], minlength=(last - first) * 256)
        counts[first * 256 : last * 256] += found
    return counts.reshape(len(texts), 256)


def _entropy(counts: np.ndarray) -> np.ndarray:
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    share = counts / total
    return -(share * np.log2(np.where(share > 0, share, 1))).sum(1)


def suffixes(host: pa.Array, path: pa.Array) -> dict[str, np.ndarray]:
    """Ends of hosts and paths that statistics are kept for; empty where there is none."""
    found = {}
    for name, pattern in SUFFIXES.items():
        own = host if name in ("top_label", "last_labels") else path
        part = pc.struct_field(pc.extract_regex(own, pattern.replace("(", "(?P<end>", 1)), "end")
        found[name] = np.array(pc.fill_null(part, "").to_pylist(), dtype=object)
    return found


@dataclass
class SuffixStatistics:
    """Of every suffix in the sample: smoothed share of blocked URLs, and log of their number."""

    average: float
    known: dict[str, dict[str, tuple[float, float]]]

    @classmethod
    def of(cls, found: dict[str, np.ndarray], labels: np.ndarray) -> SuffixStatistics:
        average = float((labels.sum() + 1) / (len(labels) + 2))
        known = {}
        for name, values in found.items():
            names, place = np.unique(values.astype(str), return_inverse=True)
            rows, blocked = np.bincount(place, minlength=len(names)), np.bincount(place, labels, len(names))
            share = (blocked + PRIOR * average) / (rows + PRIOR)
            known[name] = {n: (s, c) for n, s, c in zip(names.tolist(), share.tolist(), np.log1p(rows).tolist())}
        return cls(average, known)

    def columns(self, found: dict[str, np.ndarray]) -> np.ndarray:
        made = []
        for name, values in found.items():
            pairs = [self.known[name].get(value, (self.average, 0.0)) for value in values.tolist()]
            made.append(np.array(pairs, dtype=float).reshape(-1, 2))
        return np.column_stack(made)

    @classmethod
    def from_other_folds(cls, found: dict[str, np.ndarray], labels: np.ndarray) -> np.ndarray:
        """Columns of the sample itself, every row's from the folds it is not in."""
        fold = np.arange(len(labels)) % FOLDS
        made = np.zeros((len(labels), 2 * len(found)))
        for number in range(FOLDS):
            other, own = fold != number, fold == number
            statistics = cls.of({name: values[other] for name, values in found.items()}, labels[other])
            made[own] = statistics.columns({name: values[own] for name, values in found.items()})
        return made


def lexical(url: pa.Array, host: pa.Array, path: pa.Array) -> np.ndarray:
    """Per URL (null: empty) all of ``FEATURES`` but the suffix statistics."""
    counts = {"url": byte_counts(url), "host": byte_counts(host), "path": byte_counts(path)}
    # The host is lower-cased, so what is left after it is told from lengths and from bytes that have no case.
    counts["rest"] = np.maximum(counts["url"] - counts["host"] - counts["path"], 0)
    size = {name: table.sum(1) for name, table in counts.items()}
    digits = {name: table[:, ord("0") : ord("9") + 1].sum(1) / np.maximum(size[name], 1) for name, table in counts.items()}
    mark = lambda name, sign: counts[name][:, ord(sign)]
    query = mark("rest", "?") > 0
    secure = pc.fill_null(pc.starts_with(url, "https://"), False).to_numpy(zero_copy_only=False)
    return np.column_stack([
        np.log1p(size["url"]), size["host"], np.log1p(size["path"]), np.log1p(size["url"] - size["host"] - size["path"]),
        mark("host", "."), mark("path", "/"), digits["host"], digits["path"], digits["rest"],
        _entropy(counts["host"]), _entropy(counts["path"]), mark("host", "-"), mark("path", "-"),
        query + mark("rest", "&"), mark("rest", "="), mark("url", "%"), mark("rest", "#") > 0, secure,
    ]).astype(float)


@dataclass
class Trees:
    """Boosted trees of equal depth: node n of a level has nodes 2n and 2n + 1 below it."""

    base: float
    features: np.ndarray  # trees x inner nodes
    limits: np.ndarray  # a value up to the limit goes left
    leaves: np.ndarray  # trees x leaves

    def logit(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            node = np.zeros(len(rows), np.int64)  # in the order of levels: children of n are 2n + 1 and 2n + 2
            for _ in range(int(np.log2(len(leaves)))):
                node = 2 * node + 1 + (rows[every, features[node]] > limits[node])
            total += leaves[node - len(features)]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(rows), -30, 30)))


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Second-order boosting of the logistic loss; splits are searched over histograms of binned values.

    Ties go to the first feature and limit. Labels of one kind only give that kind's rate and no splits.
    """
    rate = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(rate / (1 - rate)))
    inner, last = (1 << depth) - 1, 1 << depth
    if len(np.unique(labels)) < 2:
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, last)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in rows.T]
    binned = np.stack([np.searchsorted(edge, column, side="left") for edge, column in zip(edges, rows.T)])
    logit = np.full(len(rows), base)
    made = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, last)))
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-logit))
        slope, bend = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            width, offset = 1 << level, (1 << level) - 1
            gain = np.full((width, len(edges), BINS), -np.inf)
            for number, column in enumerate(binned):
                place = (node - offset) * BINS + column
                left = [np.bincount(place, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (slope, bend)]
                whole = [part[:, -1:] for part in left]
                right = [total - part for total, part in zip(whole, left)]
                worth = sum(g**2 / (h + PENALTY) for g, h in (left, right)) - whole[0] ** 2 / (whole[1] + PENALTY)
                allowed = (left[1] >= LEAST / 4) & (right[1] >= LEAST / 4) & (np.arange(BINS) < len(edges[number]))
                gain[:, number] = np.where(allowed, worth, -np.inf)
            best = gain.reshape(width, -1).argmax(1)
            feature, cut = best // BINS, best % BINS
            for n in range(width):
                if gain[n, feature[n], cut[n]] > 1e-9:
                    made.features[tree, offset + n] = feature[n]
                    made.limits[tree, offset + n] = edges[feature[n]][cut[n]]
            own = made.features[tree, node]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), own] > made.limits[tree, node])
        leaf = node - inner
        weight = np.bincount(leaf, slope, last) / (np.bincount(leaf, bend, last) + PENALTY)
        made.leaves[tree] = -RATE * weight
        logit += made.leaves[tree, leaf]
    return made


@dataclass
class UrlModel:
    statistics: SuffixStatistics
    trees: Trees

    def score(self, url: pa.Array, host: pa.Array, path: pa.Array) -> np.ndarray:
        scores = np.zeros(len(url))
        for begin in range(0, len(url), ROWS):
            part = [column.slice(begin, ROWS) for column in (url, host, path)]
            rows = np.column_stack((lexical(*part), self.statistics.columns(suffixes(*part[1:]))))
            scores[begin : begin + len(rows)] = self.trees.score(rows)
        return scores


def train(labelled: DataFrame, url: str = "url", label: str = "label", limit: int = TRAIN_URLS) -> UrlModel:
    """Fit on at most ``limit`` distinct labelled URLs (label 1: block), picked by a hash of the URL.

    Null labels and URLs teach nothing; a URL with several labels teaches each once. Without any labelled URL
    every URL scores 0.5. The driver holds the sample, its suffixes and the trees: a bounded amount.
    """
    rows = labelled.select(F.col(url).alias("url"), (F.col(label) > 0).cast("int").alias("label")).dropna()
    place = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.filter(place * max(rows.count(), 1) < limit).distinct()
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(limit)
    found = rows.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label").toArrow()
    found = found.combine_chunks().sort_by([("url", "ascending"), ("label", "ascending")])
    parts = [_text(found.column(name)) for name in ("url", "host", "path")]
    labels = found.column("label").to_numpy().astype(float)
    ends = suffixes(*parts[1:])
    rows = np.column_stack((lexical(*parts), SuffixStatistics.from_other_folds(ends, labels)))
    return UrlModel(SuffixStatistics.of(ends, labels), fit_trees(rows, labels))


def _text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def judge(urls: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule, score (the trees' probability that the URL is to be blocked) and verdict.

    The verdict is that of the longest rule that fits, else the trees'. Every row is judged for itself: null and
    empty URLs and those without ``://`` have empty host and path, meet no rule and get the trees' verdict;
    equal URLs get equal verdicts; very long ones are counted in pieces. An empty table stays empty. Columns
    that are already called like one of the new ones are replaced.
    """
    sent = urls.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for parts in batches:
            yield pa.array(sent.value.score(*map(_text, parts)))

    marked = with_rules(urls, rules, url)
    scored = marked.withColumn("score", probability(F.col(url), F.col("host"), F.col("path")))
    own = F.when(F.col("score") >= BLOCKED, BLOCK).otherwise(ALLOW)
    return scored.withColumn("verdict", F.coalesce("ruled", own)).drop("ruled")
