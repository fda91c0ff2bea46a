"""Near-duplicate texts by DartMinHash over weighted word shingles, banded joins and exact checks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, keyed, map_groups, map_rows, passing, saved
from .graph import components, hung
from .hashing import STEP, U, mixed, word_codes, words_of

#: Members of a bucket that are compared at once; larger buckets are cut into blocks of about this size.
GROUP = 256
#: Texts whose darts are thrown at once hold about so many shingles.
BLOCK = 200_000
#: Elements of all sets of a block that are counted at once.
COUNTED = 500_000


def shingles(text: str | None, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of so many words, ascending, and how often each occurs.

    Words stand between ASCII white space. A shorter text is one shingle, one without words has none.
    """
    codes = word_codes(text)
    size = min(words, len(codes))
    if not size:
        return np.zeros(0, U), np.zeros(0, np.int64)
    n = len(codes) - size + 1
    found = np.full(n, U(size))
    for i in range(size):
        found = mixed(found + codes[i : i + n] + STEP)
    return np.unique(found, return_counts=True)


def dart_signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """A row of ``size`` values per weighted set, none of which may be empty.

    Each element has a plane of weight by time, cut along the weight into strips [0, 1), [1, 2), [2, 4),
    ... Darts hit a strip at a rate equal to its width, at places and times that are hashes of element,
    strip and number of the dart. A set meets the darts below its weights. Every dart also picks one of
    the ``size`` coordinates, and the earliest on each coordinate is its value: two sets agree on one with
    probability sum(min) / sum(max) of their weights. A time in proportion to 1 / total weight gives all
    but a few sets a dart on every coordinate; it is doubled for the rest.
    """
    out = np.zeros((len(sets), size), U)
    todo = np.arange(len(sets))
    limit = np.array([size * (np.log(size) + 3.0) / weights.sum() for _, weights in sets])
    while len(todo):
        darts = _throw([sets[i] for i in todo], limit[todo], size)
        row, coordinate, time, name = darts
        place = row * size + coordinate
        order = np.lexsort((name, time, place))
        first = order[np.concatenate([[True], place[order][1:] != place[order][:-1]])]
        out[todo[row[first]], coordinate[first]] = name[first]
        filled = np.bincount(row[first], minlength=len(todo)) == size
        todo = todo[~filled]
        limit[todo] *= 2.0
    return out


def _times_step(n: int) -> np.uint64:
    return U(n * int(STEP) % 2**64)


def _throw(sets, limit: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(row, coordinate, time, name) of all darts that hit the sets before their limits."""
    lengths = [len(e) for e, _ in sets]
    row = np.repeat(np.arange(len(sets)), lengths)
    element = np.concatenate([e for e, _ in sets])
    weight = np.concatenate([w for _, w in sets]).astype(np.float64)
    found = []
    low, width, strip = 0.0, 1.0, 0
    while len(row):
        seed = mixed(element + _times_step(strip + 1))
        r, s, w = row, seed, weight
        time = np.zeros(len(r))
        number = 0
        while len(r):
            name = mixed(s + _times_step(number))
            time = time - np.log(((name >> U(11)).astype(np.float64) + 0.5) / 2.0**53) / width
            near = time < limit[r]
            r, s, w, time, name = r[near], s[near], w[near], time[near], name[near]
            more = mixed(name + STEP)
            where = low + width * ((more >> U(40)).astype(np.float64) / 2.0**24)
            hit = where < w
            found.append((r[hit], ((more & U(0xFFFFFFFF)) % U(size)).astype(np.int64)[hit], time[hit], name[hit]))
            number += 1
        low, width, strip = low + width, max(1.0, low + width), strip + 1
        heavier = weight > low
        row, element, weight = row[heavier], element[heavier], weight[heavier]
    return tuple(np.concatenate(parts) for parts in zip(*found))


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per row and band."""
    rows, size = signatures.shape
    values = signatures.reshape(rows, bands, size // bands)
    keys = np.tile(np.arange(bands, dtype=U), (rows, 1)) * STEP
    for i in range(values.shape[2]):
        keys = mixed(keys + values[:, :, i] + STEP)
    return keys


def signed(docs: DataFrame, words: int, bands: int, band_rows: int) -> DataFrame:
    """doc_id, copy_key (equal for equal sequences of words), weight (number of shingles) and band keys.

    Only rows with an id and a word.
    """

    def flush(held) -> Iterator[tuple]:
        if held:
            keys = band_keys(dart_signatures([s for _, _, s in held], bands * band_rows), bands).view(np.int64)
            for (doc_id, copy, (_, counts)), own in zip(held, keys.tolist()):
                yield doc_id, copy, int(counts.sum()), own

    def rows(ids, texts) -> Iterator[tuple]:
        held, load = [], 0
        for doc_id, text in zip(ids, texts):
            found = shingles(text, words)
            if not len(found[0]):
                continue
            copy = xxhash.xxh128_digest(b" ".join(words_of(text)))
            held.append((doc_id, copy, found))
            load += len(found[0]) + 500
            if load >= BLOCK:
                yield from flush(held)
                held, load = [], 0
        yield from flush(held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    return map_rows(known, rows, f"doc_id {kind}, copy_key binary, weight long, keys array<bigint>")


def counted_elements(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A weighted set as a plain one, ascending: the second and further occurrences get names of their own.

    Two such sets have as many elements in common as the smaller weights sum up to.
    """
    if (counts == 1).all():
        return elements
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    again = np.repeat(elements, counts)
    return np.sort(np.where(turn == 0, again, mixed(again + turn.astype(U) * STEP)))


def _element_rows(docs: DataFrame, words: int) -> DataFrame:
    def rows(ids, texts) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            yield doc_id, counted_elements(*shingles(text, words)).tobytes()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), rows, f"doc_id {kind}, elements binary")


def _links(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are similar enough, by their whole shingle sets.

    Pairs and ids are written first, so that Spark knows how few they are and moves the shingles of those only.
    Shingles are sorted and merged with them at any size: a small table moves its share of them as a large one does.
    """
    pairs = saved(pairs, "pairs")
    asked = saved(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "asked")
    known = known.join(asked, "doc_id", "left_semi")
    right = known.select(F.col("doc_id").alias("b"), F.col("elements").alias("eb"))
    left = known.select(F.col("doc_id").alias("a"), F.col("elements").alias("ea"))
    met = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "ea", "eb")

    def rows(*columns) -> Iterator[tuple]:
        for a, b, ea, eb in zip(*columns):
            x, y = np.frombuffer(ea, U), np.frombuffer(eb, U)
            both = int((y[np.searchsorted(y, x).clip(max=len(y) - 1)] == x).sum())
            if both / (len(x) + len(y) - both) >= similarity:
                yield a, b

    kind = known.schema["doc_id"].dataType.simpleString()
    return map_rows(met, rows, f"a {kind}, b {kind}")


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """Of each two different plain sets the size of what they share by the size of what either has.

    The elements, which are hashes, are taken in ranges: so much memory for long texts as for short ones.
    """
    sizes = np.array([len(s) for s in sets])
    ranges = int(sizes.sum()) // COUNTED + 1
    edges = np.array([i * 2**64 // ranges for i in range(ranges)], U)
    cuts = [[*np.searchsorted(s, edges).tolist(), len(s)] for s in sets]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for i in range(ranges):
        both += _shared([s[c[i] : c[i + 1]] for s, c in zip(sets, cuts)])
    return both / (sizes[:, None] + sizes[None, :] - both)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two plain sets share."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times[column] > 1  # the others add nothing
    row, column = row[several], (np.cumsum(times > 1) - 1)[column[several]]
    both = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        start, stop = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[start:stop], column[start:stop] - low] = 1
        both += part @ part.T
    return both


def _cross_links(texts: DataFrame, classes: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Links between members of different classes that share a bucket: every such pair is compared.

    In a bucket the members of its largest class need no comparison among themselves; they are cut into
    blocks, the others into blocks of their own, and each block of others meets each block. A pair that
    shares several buckets is compared in the first, and only if the numbers of shingles allow a link. Which
    pairs those are is told by keys and numbers alone, and shingles move to the blocks that have such a pair
    of theirs. Links come out as a tree per block: id a hangs together with id b.
    """
    own = texts.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    own = saved(own.withColumn("component", F.coalesce("component", "doc_id")), "labelled")
    members = own.select("doc_id", "component", F.explode("keys").alias("key"))
    sizes = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("key").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("classes")
    )
    buckets = saved(buckets.where("classes > 1").select("key", "main", "all"), "mixed")
    met = members.join(buckets, "key")
    main = F.col("component") == F.col("main.component")
    others = F.ceil((F.col("all") - F.col("main.n")) / F.lit(GROUP)).cast("int")
    mains = F.ceil(F.col("main.n") / F.lit(GROUP)).cast("int")
    met = met.select("doc_id", "component", "key", main.alias("main"), others.alias("others"), mains.alias("mains"))
    met = met.join(own.select("doc_id", "weight", "keys"), "doc_id")  # before blocks multiply the members
    deal = F.xxhash64("doc_id", "key")
    place = F.when(F.col("main"), F.col("others") + F.pmod(deal, "mains")).otherwise(F.pmod(deal, "others"))
    most = F.when(F.col("main"), F.col("others")).otherwise(F.col("others") + F.col("mains"))
    met = met.withColumn("place", place.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), most - 1)))
    block = ["key", F.least("place", "other").alias("low"), F.greatest("place", "other").alias("high")]
    met = met.select(*block, "doc_id", "component", "place", "weight", "keys")

    def to_compare(key, component, place, weight, keys) -> np.ndarray:
        """Which pairs of a block this block has to compare."""
        bucket, low, high = key
        component, place, weight, keys = (np.array(x) for x in (component, place, weight, keys))
        wanted = component[:, None] != component[None, :]
        if low != high:
            wanted &= place[:, None] != place[None, :]
        wanted &= _may_be_alike(weight, similarity)
        for earlier in range(int((keys[0] == bucket).argmax()) if wanted.any() else 0):
            wanted &= keys[:, earlier][:, None] != keys[:, earlier][None, :]
        return wanted

    def choose(key, rows) -> Iterator[tuple]:
        _, *told = zip(*rows)
        for i in np.flatnonzero(to_compare(key, *told).any(axis=1)):
            yield (*key, *rows[i])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema)
    met = saved(map_groups(met, ["key", "low", "high"], choose, schema), "compared")
    asked = saved(met.select("doc_id").distinct(), "asked")
    met = met.join(known.join(asked, "doc_id", "left_semi"), "doc_id")

    def compare(key, rows) -> Iterator[tuple]:
        ids, *told, elements = zip(*rows)
        near = similarities([np.frombuffer(e, U) for e in elements]) >= similarity
        near &= to_compare(key, *told)
        first = hung(near)
        for i in np.flatnonzero(near.any(axis=1)):
            yield ids[i], ids[first[i]]

    kind = texts.schema["doc_id"].dataType.simpleString()
    met = met.select("key", "low", "high", "doc_id", "component", "place", "weight", "keys", "elements")
    return map_groups(met, ["key", "low", "high"], compare, f"a {kind}, b {kind}")


def _may_be_alike(weight: np.ndarray, similarity: float) -> np.ndarray:
    """Of each two sets of so many shingles, whether they could be similar enough: sum(min) is the smaller at most."""
    return np.minimum.outer(weight, weight) >= similarity * np.maximum.outer(weight, weight) - 1e-6


def shared_keys(members: DataFrame) -> DataFrame:
    """key, doc_id and low, the smallest doc_id of the key, of the ``members`` (doc_id, key) that share their key.

    Members move once: Spark reuses what was dealt by key for the join with what is aggregated of it.
    """
    dealt = members.select("key", "doc_id").repartition("key")
    ends = dealt.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return dealt.join(ends.where("low <> high").select("key", "low"), "key")


def _classes(
    docs: DataFrame, words: int, similarity: float, bands: int, band_rows: int, first_bands: int
) -> DataFrame:
    """doc_id, class_id of every text with a word, from ids that are all different."""
    own = saved(signed(docs, words, bands, band_rows), "signatures")
    texts = own.groupBy("copy_key").agg(
        F.min("doc_id").alias("text_id"), F.min_by(F.struct("weight", "keys"), "doc_id").alias("of")
    )
    copies = saved(texts.select("copy_key", "text_id", "of.weight", "of.keys"), "copies")
    texts = copies.select(F.col("text_id").alias("doc_id"), "weight", "keys")

    def members(df: DataFrame, keys) -> DataFrame:
        return df.select("*", F.explode(keys).alias("key")).drop("keys")

    shared = saved(shared_keys(members(texts.select("doc_id", "keys"), F.col("keys"))), "shared")
    open_keys = shared.where("doc_id = low").select("key", "low")
    met = saved(shared.select("doc_id").distinct(), "candidates")
    known = saved(_element_rows(docs.join(met, "doc_id", "left_semi"), words), "shingles")
    texts = saved(texts.join(met, "doc_id", "left_semi"), "texts")

    def alike(a: str, b: str) -> str:
        return f"least({a}, {b}) >= {similarity} * greatest({a}, {b})"

    weights = texts.select(F.col("doc_id").alias("a"), F.col("weight").alias("wa"))
    star = members(texts, F.slice("keys", 1, first_bands)).join(open_keys, "key").where("doc_id <> low")
    star = star.select(F.col("low").alias("a"), F.col("doc_id").alias("b"), "weight").distinct()
    star = star.join(weights, "a").where(alike("weight", "wa")).select("a", "b")
    links = saved(_links(star, known, similarity), "links")
    links = links.unionByName(_cross_links(texts, components(links), known, similarity))
    classes = components(links)

    found = own.select("doc_id", "copy_key").join(copies, "copy_key").select("doc_id", "text_id")
    found = found.join(classes.withColumnRenamed("id", "text_id"), "text_id", "left")
    return found.select("doc_id", F.coalesce("component", "text_id").alias("class_id"))


def near_duplicate_rows(
    rows: DataFrame,
    row: str = ROW,
    words: int = 5,
    similarity: float = 0.8,
    bands: int = 24,
    band_rows: int = 5,
    first_bands: int = 4,
) -> DataFrame:
    """``row``, class_row of each row of a ``keyed`` table that has a word; doc_id plays no part.

    Rows are linked as documents are in ``near_duplicates``; class_row is the smallest key of the class.
    """
    texts = rows.select(F.col(row).alias("doc_id"), "text")
    with passing(rows.sparkSession) as keep:
        found = _classes(texts, words, similarity, bands, band_rows, first_bands)
        return keep(found.select(F.col("doc_id").alias(row), F.col("class_id").alias("class_row")), "classes")


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, **bands: int) -> DataFrame:
    """doc_id, class_id, kept: one row per id.

    Documents are linked whose weighted sets of ``words``-word shingles (weight: occurrences) have a
    similarity sum(min) / sum(max) of at least ``similarity``, and classes are the connected components;
    class_id is the smallest id of the class, the one that is kept. 24 bands of 5 values miss a link at 0.8
    with a probability of 7 in 100,000, and fewer above.

    Documents with the same words are one text, of which the first goes on. Texts that share a band
    key are candidates. To spare comparing all of a bucket, the first bands link each member with the
    smallest; after that only members of different classes matter, and all of those that share a bucket
    are compared, in blocks (see ``_cross_links``), so no bucket is capped. All comparisons are exact.

    NULL and empty texts are like nothing and kept. Rows with one id are one document, which is linked by
    each of its texts. A NULL id has a row of its own, class_id NULL and kept; ``near_duplicate_rows``
    compares such rows too. Other columns are ignored; an empty table gives no rows.
    """
    with passing(docs.sparkSession) as keep:
        rows, row = keyed(docs.where("doc_id IS NOT NULL").select("doc_id", "text"))
        found = near_duplicate_rows(rows, row, words, similarity, **bands)
        named = keep(rows.select(row, "doc_id").join(found, row).select("doc_id", "class_row"), "named")
    # Texts of one id bring their classes together.
    own = named.groupBy("doc_id").agg(F.min("class_row").alias("class_row"), F.max("class_row").alias("_high"))
    several = own.where("class_row < _high").select("doc_id", F.col("class_row").alias("b"))
    joined = components(named.join(several, "doc_id").select(F.col("class_row").alias("a"), "b"))
    own = own.join(joined.withColumnRenamed("id", "class_row"), "class_row", "left")
    own = own.select("doc_id", F.coalesce("component", "class_row").alias("class_row"))
    classes = own.groupBy("class_row").agg(F.min("doc_id").alias("class_id"))
    found = own.join(classes, "class_row").select("doc_id", "class_id")
    every = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    every = every.join(found, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    nobody = docs.where("doc_id IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    return every.unionByName(nobody).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
