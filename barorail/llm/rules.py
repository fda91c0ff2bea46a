"""Quality rules: an isolation forest over rule statistics finds the documents unlike ordinary ones."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_counts, value_counts
from .common import labelled, map_rows, saved

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: More counts that only the forest looks at.
EXTRA = ("n_upper", "n_marks", "n_short")
SYMBOLS = [ord(c) for c in "#*$%&|<>"]
MARKS = [ord(c) for c in "!?.,;:\"'()[]{}=_+/\\~^`@-"]
SPACES = [0x20, *range(0x09, 0x0E)]


def text_counts(text: str) -> tuple[int, ...]:
    """COUNTS and EXTRA of one text; words are runs of anything but ASCII white space."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    seen: set[bytes] = set()
    dups = 0
    for line in data.split(b"\n"):
        if line.strip():
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    repeated = 0
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) < n - 2:
        again = np.fromiter((windows[w] > 1 for w in zip(words, words[1:], words[2:])), bool, n - 2)
        hit = np.zeros(n, bool)
        for shift in range(3):
            hit[shift : n - 2 + shift] |= again
        repeated = int(hit.sum())
    return (
        n,
        len(text) - int(bytes_[SPACES].sum()),
        int(bytes_[SYMBOLS].sum()),
        dups,
        repeated,
        int(bytes_[65:91].sum()),
        int(bytes_[MARKS].sum()),
        sum(len(w) <= 3 for w in words),
    )


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text; a NULL text has none of anything."""

    def rows(ids, texts):
        for i, t in zip(ids, texts):
            yield (i, *text_counts(t or ""))

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in (*COUNTS, *EXTRA))
    return map_rows(docs.select("doc_id", "text"), rows, f"doc_id {kind}, {counts}")


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Roots of shares, so that texts of any length are comparable and small shares differ.

    Length and repeated lines are left to the base rules: long and short texts and license lines are as
    common among good documents, and a forest would take them for the strangest of all.
    """
    n = np.maximum(counts["n_words"], 1)
    chars = np.maximum(counts["word_chars"], 1)
    return np.sqrt(
        np.column_stack(
            [
                counts["word_chars"] / n,
                counts["n_symbols"] / n,
                counts["n_repeat_words"] / n,
                counts["n_upper"] / chars,
                counts["n_marks"] / chars,
                counts["n_short"] / n,
            ]
        )
    )


@dataclass(frozen=True)
class IsolationForest:
    """Random trees as arrays of whole binary trees: node i has the children 2i + 1 and 2i + 2.

    ``depth[tree, leaf]`` is the path length a row ends with, including what an unsplit leaf of many
    rows would still have taken on average.
    """

    column: np.ndarray
    split: np.ndarray
    depth: np.ndarray
    rows: int

    @classmethod
    def fit(cls, x: np.ndarray, trees: int = 100, rows: int = 1024, seed: int = 11) -> IsolationForest:
        """Every tree grows on at most ``rows`` rows of ``x``, drawn for it."""
        rng = np.random.default_rng(seed)
        rows = min(rows, len(x))
        height = height_of(rows)
        parts = [grown(x[rng.choice(len(x), rows, replace=False)], height, rng) for _ in range(trees)]
        return cls(*(np.array(p) for p in zip(*parts)), rows)

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the shorter the mean path, the higher."""
        total = np.zeros(len(x))
        at = np.arange(len(x))
        for column, split, depth in zip(self.column, self.split, self.depth):
            node = np.zeros(len(x), np.int64)
            for _ in range(len(split).bit_length()):
                node = 2 * node + 1 + (x[at, column[node]] >= split[node])
            total += depth[node - len(split)]
        return 2.0 ** (-total / len(self.depth) / max(usual_depth(self.rows), 1e-9))


def height_of(rows: int) -> int:
    return max(1, int(np.ceil(np.log2(max(rows, 2)))))


def grown(x: np.ndarray, height: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """column, split and depth of one tree that takes all rows of ``x`` apart, in whatever order they come."""
    inner = 2**height - 1
    column, split, depth = np.zeros(inner, np.int32), np.full(inner, np.inf), np.zeros(inner + 1)
    todo = [(0, 0, x)]
    while todo:
        node, level, part = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        open_columns = np.flatnonzero(high > low)
        if level == height or not len(open_columns):
            first = (node + 1 - 2**level) << (height - level)
            depth[first : first + 2 ** (height - level)] = level + usual_depth(len(part))
            continue
        c = rng.choice(open_columns)
        at = rng.uniform(low[c], high[c])
        at = at if low[c] < at else high[c]
        column[node], split[node] = c, at
        below = part[:, c] < at
        todo += [(2 * node + 1, level + 1, part[below]), (2 * node + 2, level + 1, part[~below])]
    return column, split, depth


def usual_depth(n: int) -> float:
    """Mean path length of an unsuccessful search among n keys of a random binary tree."""
    if n < 2:
        return 0.0
    return 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def calibrate(anomaly: np.ndarray, good: np.ndarray, false_rejects: float) -> float:
    """The lowest threshold that rejects at most that share of the good rows; inf without good rows."""
    ordered = np.sort(anomaly[good == 1])
    if not len(ordered):
        return np.inf
    return float(ordered[-1 - int(false_rejects * len(ordered))])


def threshold(anomalies: DataFrame, rows: int, false_rejects: float) -> float:
    """What ``calibrate`` finds for the ``anomaly`` of so many good rows, from all of them and exactly."""
    place = rows - 1 - int(false_rejects * rows)
    ranked = running_counts(value_counts(anomalies, [], "anomaly"), [], "anomaly")
    return ranked.where((F.col("before") <= place) & (F.col("before") + F.col("n") > place)).head()["anomaly"]


def fit_forest(good: DataFrame, rows: int, trees: int = 100, tree_rows: int = 1024, seed: int = 11) -> IsolationForest:
    """A forest that grows on all ``rows`` rows of ``good``, in groups of a tree each.

    The rows are dealt to shares of about ``tree_rows`` by hash, anew in every round, and every share of a
    round makes a tree, so each row is in one tree at least. There are as many shares as trees at most: beyond
    ``trees * tree_rows`` rows a tree has its part of them, with no more nodes.
    """
    shares = min(trees, max(1, rows // tree_rows))
    rounds = -(-trees // shares)
    height = height_of(min(tree_rows, rows))
    names = [*COUNTS, *EXTRA]
    share = F.pmod(F.xxhash64("doc_id", *names, "round"), F.lit(shares))
    dealt = good.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    dealt = dealt.select((F.col("round") * shares + share).cast("int").alias("tree"), *names).where(F.col("tree") < trees)

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        found = grown(features({c: part[c].to_numpy() for c in names}), height, np.random.default_rng([seed, tree]))
        return pd.DataFrame({"tree": [tree]} | {c: [a.tolist()] for c, a in zip(("column", "split", "depth"), found)})

    schema = "tree int, column array<int>, split array<double>, depth array<double>"
    told = sorted(dealt.groupBy("tree").applyInPandas(grow, schema).collect())
    return IsolationForest(*(np.array([r[c] for r in told]) for c in ("column", "split", "depth")), rows // shares)


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    false_rejects: float = 0.005,
) -> DataFrame:
    """doc_id, the COUNTS, base_failed, kept, anomaly of every row.

    A document fails the base rules with fewer than ``min_words`` words or when more than
    ``max_repeat_percent`` per cent of them stand in repeated 3-word windows. The others are kept unless
    their anomaly is above the threshold that spares all but ``false_rejects`` of the good examples.
    Forest and threshold come from the statistics of all good examples that pass the base rules; with fewer
    than two, nothing more is rejected. NULL and empty texts have no words and fail; repeated rows stay; a NULL
    doc_id is kept as it is; an empty table gives no rows.
    """
    # The statistics are small and used twice: for the examples and for all rows.
    counts = saved(rule_statistics(docs), "rules")
    names = (*COUNTS, *EXTRA)
    n, again = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < min_words) | (100 * again > max_repeat_percent * n)
    examples = labelled(labels, "quality").where("quality = 1").select("doc_id")
    good = saved(counts.where(~failed).join(examples, "doc_id"), "examples")
    known = good.count()
    forest = fit_forest(good, known) if known > 1 else None

    def score(ids, *columns):
        rows = {c: np.array(v, np.int64) for c, v in zip(names, columns)}
        anomaly = forest.anomaly(features(rows)) if forest else np.zeros(len(ids))
        yield from zip(ids, *columns[: len(COUNTS)], anomaly.tolist())

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)

    def scored(rows: DataFrame) -> DataFrame:
        return map_rows(rows.select("doc_id", *names), score, schema + ", anomaly double")

    limit = threshold(scored(good), known, false_rejects) if forest else np.inf
    return scored(counts).select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.col("anomaly") <= F.lit(limit))).alias("kept"),
        "anomaly",
    )
