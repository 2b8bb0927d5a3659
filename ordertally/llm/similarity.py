"""Near-duplicate documents: a join on the Jaccard similarity of word shingles.

The incidence matrix has a row for each distinct set of shingles (a class of documents) and
a column for each shingle; the product of the matrix with its own transpose counts what two
classes share. The columns come in blocks, the same for all classes: rare columns by hash,
then the common ones, those that chunks of tasks see again and again, by how common they
are. The product is worked out for the pairs alone that bounds by size leave:

1. A class is multiplied in its first blocks: as many as it takes to hold n - ceil(t n) + 1
   of its n shingles. Linked sets share one of these, in a block that both have come to.
   Columns that occur once there are dropped.
2. Of two classes the one with fewer blocks says how large the overlap can be: its columns
   in these blocks that occur again, its reach so far, and all that lies behind them.
   Classes leave the columns in which no pair can come to what a link needs.
3. In each column a class meets two pivots instead of all others: the class with the fewest
   shingles of its own, the hub of a group of near copies, and one by hash.
4. For pairs that may be linked the overlap is added up block by block from both whole
   sets; after each block those pairs go whose count, with the least of what both have
   left, falls short of what a link needs.
5. The links join classes to components. Of classes in different components still, all
   pairs that share a column are looked at in the same way, in the first column that they
   share: the columns that both have from there on, and what lies behind, bound the overlap.
   So every link between components is found, and a group of n near copies costs about n
   pairs and not their square.

Shingles and sets are told apart by 64-bit hashes. A null text has no words; a document
without words has an empty set and is linked with nothing; a text shorter than a shingle is
one shingle. A row with a null key takes part; a component of null keys alone has a null
id. Repeated rows are in one class. An empty table gives no rows. A text of 2**29 shingles
or more raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ordertally.llm.common import (
    marked_copies,
    one_of_each,
    read_table,
    slices,
    stored,
    texts_of,
    unused,
    without,
    work_folder,
)
from ordertally.llm.components import components
from ordertally.llm.matching import CHUNK, SENT_WIDE, Chunk, repeated
from ordertally.llm.words import mixed, paired, words_of
from ordertally.operators.sizes import fits_broadcast

SHINGLE = 5
PERCENT = 75
# Shingles that are put last: seen so often within chunks, and at most so many of them.
COMMON_COUNT, COMMON_SHINGLES = 16, 2**18
# Blocks of rare columns: the first quarter of a set ends in the middle of a block, mostly.
BLOCKS = 10
# Blocks in all: a block of common columns for each power of two of how often they are seen.
LAST_BLOCK = 31
_BITS, _BLOCK_BITS = 29, 5


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of all texts, repeated ones too, and the text that each is of."""
    words = words_of(texts, lower=True)
    hashes = words.hashes()
    counts = np.diff(words.first)
    whole = np.flatnonzero(counts >= size)
    many = counts[whole] - size + 1
    text = np.repeat(whole, many)
    starts = np.arange(many.sum()) + np.repeat(words.first[whole] - (np.cumsum(many) - many), many)
    names = hashes[starts]
    for step in range(1, size):
        names = paired(names, hashes[starts + step])
    short, short_text = [], []
    for one in np.flatnonzero((counts > 0) & (counts < size)).tolist():
        name = np.array([counts[one]], dtype=np.uint64)
        for number in hashes[words.first[one] : words.first[one + 1]]:
            name = paired(name, number)
        short.append(name)
        short_text.append(one)
    if short:
        names = np.concatenate((names, *short))
        text = np.concatenate((text, np.array(short_text)))
    return names, text


def distinct(names: np.ndarray, text: np.ndarray, ranks: np.ndarray | None = None):
    """Without repeats, by text, then rank, then name."""
    keys = (names, text) if ranks is None else (names, ranks, text)
    order = np.lexsort(keys)
    names, text = names[order], text[order]
    keep = np.ones(len(names), dtype=bool)
    keep[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    return names[keep], text[keep]


def class_ids(names: np.ndarray, text: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and identity of each text's set; equal sets have equal identities."""
    sizes = np.bincount(text, minlength=count)
    sums = np.zeros((2, count), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        firsts = (np.cumsum(sizes) - sizes)[full]
        for k in range(2):
            spread = mixed(names + np.uint64(k + 1))
            sums[k, full] = np.add.reduceat(spread, firsts)
    ids = paired(paired(sums[0], sums[1]), sizes.astype(np.uint64))
    return sizes, ids.view(np.int64)


def _sets(batch: pa.RecordBatch):
    names, text = distinct(*shingles(batch.column("text").to_pylist()))
    sizes, ids = class_ids(names, text, batch.num_rows)
    return names, text, sizes, ids


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        _, _, sizes, ids = _sets(batch)
        more = [name for name in batch.schema.names if name not in ("doc_id", "text")]
        columns = [batch.column("doc_id"), pa.array(sizes), pa.array(ids), *map(batch.column, more)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "class", *more])


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that a chunk holds in several sets, and in how many."""

    def close(parts: list[np.ndarray]) -> pa.RecordBatch:
        names, counts = np.unique(np.concatenate(parts), return_counts=True)
        names, counts = names[counts > 1].view(np.int64), counts[counts > 1]
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], ["name", "times"])

    parts: list[np.ndarray] = []
    size = 0
    for batch in slices(batches):
        parts.append(_sets(batch)[0])
        size += len(parts[-1])
        if size >= CHUNK:
            yield close(parts)
            parts, size = [], 0
    if parts:
        yield close(parts)


def common_shingles(firsts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, a bounded number, and how often chunks saw them."""
    seen = firsts.mapInArrow(_often, "name bigint, times bigint")
    totals = seen.groupBy("name").agg(F.sum("times").alias("times"))
    often = totals.where(F.col("times") >= COMMON_COUNT)
    table = often.orderBy(F.desc("times"), "name").limit(COMMON_SHINGLES).toArrow()
    names = table.column("name").to_numpy().view(np.uint64)
    order = np.argsort(names)
    return names[order], table.column("times").to_numpy()[order]


def blocks_of(names: np.ndarray, common: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The block that each shingle's column is in."""
    blocks = ((names >> np.uint64(32)) * np.uint64(BLOCKS) >> np.uint64(32)).astype(np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, names), len(common) - 1)
        often = np.log2(times[at] / COMMON_COUNT).astype(np.int64)
        late = np.minimum(BLOCKS + np.maximum(often, 0), LAST_BLOCK)
        blocks = np.where(common[at] == names, late, blocks)
    return blocks


def needed(one: Column, other: Column) -> Column:
    """The least overlap of linked sets."""
    return F.ceil((one + other) * PERCENT / (100 + PERCENT))


def _multiplied(firsts: DataFrame, common: np.ndarray, times: np.ndarray) -> DataFrame:
    """Column, class, its size, its last block, and its shingles behind that, for the
    shingles of every set in its first blocks."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(wide=True)
        for batch in slices(batches):
            names, text = shingles(batch.column("text").to_pylist())
            names, text = distinct(names, text, blocks_of(names, common, times))
            sizes, ids = class_ids(names, text, batch.num_rows)
            if sizes.max(initial=0) >= 2**_BITS:
                raise ValueError("a text has too many shingles")
            blocks = blocks_of(names, common, times)
            firsts = np.cumsum(sizes) - sizes
            enough = firsts + sizes - -(-sizes * PERCENT // 100)  # the last that is needed
            last = np.full(len(sizes), -1)
            full = np.flatnonzero(sizes)
            last[full] = blocks[enough[full]]
            keep = blocks <= last[text]
            names, text = names[keep], text[keep]
            behind = sizes - np.bincount(text, minlength=len(sizes))
            packed = (sizes << _BITS | behind) << _BLOCK_BITS | np.maximum(last, 0)
            if chunk.add(names, ids[text], packed[text]):
                yield from chunk.close()
        yield from chunk.close()

    found = repeated(firsts.mapInArrow(send, SENT_WIDE))
    place = F.col("place")
    return found.select(
        "name",
        F.col("key").alias("class"),
        F.shiftright(place, _BITS + _BLOCK_BITS).alias("size"),
        F.shiftright(place, _BLOCK_BITS).bitwiseAND(F.lit(2**_BITS - 1)).alias("behind"),
        place.bitwiseAND(F.lit(2**_BLOCK_BITS - 1)).alias("last"),
    ).distinct()


def _within_reach(columns: DataFrame) -> DataFrame:
    """The columns with each class's reach, without what cannot be linked there; and how
    many of its columns a class has from each on, rare columns first."""
    shared = columns.groupBy("class").agg(F.count("*").alias("shared"))
    known = columns.join(shared, "class").withColumn("reach", F.col("behind") + F.col("shared"))
    others = columns.groupBy("name").agg(
        F.min("size").alias("least"), F.min("last").alias("earliest"), F.count("*").alias("times")
    )
    other = F.greatest(F.col("least"), F.ceil(F.col("size") * PERCENT / 100))
    # A class's own reach bounds its pairs with classes that have no fewer blocks. Where one
    # has fewer, that one's reach counts; it may still be enough.
    near = known.join(others, "name").where(
        (F.col("reach") >= needed(F.col("size"), other))
        | ((F.col("last") > F.col("earliest")) & (F.col("size") >= needed(F.col("size"), other)))
    )
    backward = W.partitionBy("class").orderBy(F.desc("times"), F.desc("name"))
    mark = F.xxhash64("name")
    own = W.partitionBy("class")
    bits = [F.pmod(mark, F.lit(64)), F.pmod(F.shiftright(mark, 32), F.lit(64))]
    return near.select(
        "name",
        "class",
        "size",
        "behind",
        "last",
        "reach",
        F.row_number().over(backward).alias("left"),
        F.count("*").over(own).alias("all"),
        *(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int"))).over(own).alias(f"mask{k}")
            for k, bit in enumerate(bits)
        ),
    )


def _of_fewer_blocks(name: str, a: str, b: str) -> Column:
    """What the class with fewer blocks says; with as many, the lesser of both."""
    one, other = F.col(f"{name}{a}"), F.col(f"{name}{b}")
    lasts = F.col(f"last{a}"), F.col(f"last{b}")
    return (
        F.when(lasts[0] < lasts[1], one)
        .when(lasts[0] > lasts[1], other)
        .otherwise(F.least(one, other))
    )


def _linkable(a: str, b: str) -> Column:
    """Whether sizes and reaches allow a link."""
    sizes = F.col(f"size{a}"), F.col(f"size{b}")
    return F.least(_of_fewer_blocks("reach", a, b), *sizes) >= needed(*sizes)


def _enough_left() -> Column:
    """Whether a pair can be linked if no earlier column is shared.

    What the columns in blocks of both do not show lies behind the class with fewer blocks.
    Nor may one lack more of the other's columns than that can spare; each bit of a mask of
    columns that the other mask has not stands for one at least.
    """
    shared = needed(F.col("size_a"), F.col("size_b")) - _of_fewer_blocks("behind", "_a", "_b")
    allowed = F.least("left_a", "left_b") >= shared
    for mask in ("mask0", "mask1"):
        for a, b in (("a", "b"), ("b", "a")):
            lacking = F.col(f"{mask}_{a}").bitwiseAND(F.bitwise_not(f"{mask}_{b}"))
            allowed &= F.bit_count(lacking) <= F.col(f"all_{a}") - shared
    return allowed


def _overlaps(one: tuple, other: tuple, count: int, common: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Which of the pairs are linked: overlaps are added up block by block, and a pair is
    left as soon as what remains cannot bring it to a link."""
    sizes = [np.bincount(text, minlength=count) for _, text in (one, other)]
    # The least overlap of a link: 100 x >= PERCENT (sizes - x).
    least = -(-PERCENT * (sizes[0] + sizes[1]) // (100 + PERCENT))
    names, text = (np.concatenate(both) for both in zip(one, other, strict=True))
    blocks = blocks_of(names, common, times)
    order = np.lexsort((names, text, blocks))
    names, text = names[order], text[order]
    borders = np.searchsorted(blocks[order], np.arange(LAST_BLOCK + 2))
    sides = np.arange(len(order)) >= len(one[0])
    sides = sides[order]
    rest = [size.copy() for size in sizes]
    shared = np.zeros(count, dtype=np.int64)
    alive = np.ones(count, dtype=bool)
    for start, end in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if start == end:
            continue
        part, whose, side = names[start:end], text[start:end], sides[start:end]
        keep = alive[whose]
        part, whose, side = part[keep], whose[keep], side[keep]
        both = (part[1:] == part[:-1]) & (whose[1:] == whose[:-1])
        shared += np.bincount(whose[1:][both], minlength=count)
        for k in range(2):
            rest[k] -= np.bincount(whose[side == k], minlength=count)
        alive &= shared + np.minimum(*rest) >= least
    return alive


def _verified(common: np.ndarray, times: np.ndarray):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose whole sets are similar enough."""
        for batch in slices(slices(batches, "text_a"), "text_b"):
            one = distinct(*shingles(batch.column("text_a").to_pylist()))
            other = distinct(*shingles(batch.column("text_b").to_pylist()))
            linked = _overlaps(one, other, batch.num_rows, common, times)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return verify


def _links(
    pairs: DataFrame, texts: DataFrame, places: DataFrame, folder: str, often: tuple
) -> DataFrame:
    """The pairs that are links; `places` says which of the `texts` stands for a class."""
    pairs = stored(pairs, f"{folder}/pairs")
    used = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    used = stored(used.join(places, "class"), f"{folder}/used")
    known = F.broadcast(used) if fits_broadcast(used) else used
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.xxhash64("text") == F.col("its_hash"))
    wanted = texts.join(known, same).select("class", "text").dropDuplicates(["class"])
    wanted = stored(wanted, f"{folder}/texts")
    left = wanted.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = wanted.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b")
    links = both.select("a", "b", "text_a", "text_b").mapInArrow(_verified(*often), "a bigint, b bigint")
    return stored(links, f"{folder}/links")


def _pivot_pairs(columns: DataFrame) -> DataFrame:
    """Each class with the pivots of each of its columns, once."""
    mark = F.xxhash64("class")
    alone = (F.col("size") - F.col("reach")) / F.col("size")
    parts = ("class", "size", "last", "reach")
    fewest = F.min(F.struct(alone.alias("alone"), mark.alias("mark"), *parts))
    least = F.min(F.struct(mark.alias("mark"), *parts))
    pivots = columns.groupBy("name").agg(
        fewest.alias("hub"), least.alias("least"), F.max("class").alias("one"), F.min("class").alias("two")
    )
    both = [F.struct(*(f"{name}.{part}" for part in parts)) for name in ("hub", "least")]
    pivots = pivots.where("one <> two").select("name", F.array_distinct(F.array(*both)).alias("pivots"))
    met = columns.join(pivots, "name").withColumn("pivot", F.explode("pivots"))
    met = met.select(*parts, *(F.col(f"pivot.{part}").alias(f"{part}_pivot") for part in parts))
    near = met.where((F.col("class") != F.col("class_pivot")) & _linkable("", "_pivot"))
    ends = F.least("class", "class_pivot").alias("a"), F.greatest("class", "class_pivot").alias("b")
    return near.select(*ends).distinct()


def _open_pairs(columns: DataFrame, roots: DataFrame) -> DataFrame:
    """Classes that share a column and lie in different components."""
    named = columns.join(roots, F.col("class") == F.col("member"), "left").select(
        *columns.columns, F.coalesce("root", "class").alias("root")
    )
    several = named.groupBy("name").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    several = several.where("low <> high").select("name")
    kept = named.join(several, "name", "left_semi")
    parts = ("class", "size", "behind", "last", "reach", "left", "all", "mask0", "mask1", "root")
    one = kept.select("name", *(F.col(c).alias(f"{c}_a") for c in parts))
    two = kept.select("name", *(F.col(c).alias(f"{c}_b") for c in parts))
    pairs = one.join(two, "name").where(
        (F.col("class_a") < F.col("class_b"))
        & (F.col("root_a") != F.col("root_b"))
        & _linkable("_a", "_b")
        & _enough_left()
    )
    return pairs.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def near_duplicates(documents: DataFrame, folder: str, by_row: bool = False) -> DataFrame:
    """Key, size of the set, and the least key reachable by links, of every document; and
    `by_row` a hash of the text, which tells rows of one key apart, and the component's root."""
    shape = "doc_id bigint, n_shingles bigint, class bigint, text_hash bigint"
    rows = texts_of(documents).withColumn("text_hash", F.xxhash64("text"))
    classified = stored(rows.mapInArrow(_classify, shape), f"{folder}/classified")
    place = F.min(F.struct("doc_id", "text_hash")).alias("place")
    places = classified.where("n_shingles > 0").groupBy("class").agg(place).select(
        "class", F.col("place.doc_id").alias("its_id"), F.col("place.text_hash").alias("its_hash")
    )
    marked = marked_copies(documents, folder)
    firsts = marked.where("not whole or first").select("doc_id", "text")
    often = common_shingles(firsts)
    columns = stored(_multiplied(firsts, *often), f"{folder}/shared")
    columns = stored(_within_reach(columns), f"{folder}/columns")

    near = _links(_pivot_pairs(columns), texts_of(documents), places, f"{folder}/near", often)
    roots = components(near, f"{folder}/near/components")
    rest = _links(_open_pairs(columns, roots), texts_of(documents), places, f"{folder}/rest", often)
    roots = components(near.union(rest), f"{folder}/rest/components")

    classes = classified.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    rooted = classes.join(roots, F.col("class") == F.col("member"), "left").select(
        "class", "least", F.coalesce("root", "class").alias("root")
    )
    rooted = stored(rooted, f"{folder}/rooted")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.join(ids, "root").select("class", "component_id", "root")
    full = classified.where("n_shingles > 0").join(members, "class")
    empty = classified.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    empty = empty.withColumn("root", F.lit(None).cast("bigint"))
    shown = ["doc_id", "n_shingles", "component_id", *(["text_hash", "root"] if by_row else [])]
    return full.select(*shown).union(empty.select(*shown))


def keep_one(documents: DataFrame, folder: str) -> DataFrame:
    """One row of each component, that with the least key, and all rows without words.

    Null keys come last; of rows with one key the text decides, by hash, and of repeated
    rows one stays. Each row is judged by its key and its text, so a key that stands for
    two texts loses only the one that is a copy. All columns stay, whatever they are called.
    An empty table gives no rows.
    """
    found = stored(near_duplicates(documents, folder, by_row=True), f"{folder}/found")
    worded = found.where("n_shingles > 0")
    digest = unused("text_hash", documents)
    worded = worded.withColumnRenamed("text_hash", digest)
    on = ["doc_id", digest]
    place = F.struct(F.col("doc_id").isNull().alias("late"), *on)
    stay = worded.groupBy("root").agg(F.min(place).alias("stay")).select("stay.doc_id", f"stay.{digest}")
    stay = stored(stay, f"{folder}/stay")
    several = worded.groupBy(*on).agg(F.count("*").alias("times"))
    several = stored(several, f"{folder}/rows")
    gone = stored(without(several, stay, on).select(*on), f"{folder}/gone")
    twice = several.where("times > 1").select(*on)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.withColumn(digest, F.xxhash64(text))
    kept = one_of_each(without(rows, gone, on), without(twice, gone, on), on)
    return kept.select(*documents.columns)


def op2_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return near_duplicates(documents, f"{work_folder(spark)}/similarity")
