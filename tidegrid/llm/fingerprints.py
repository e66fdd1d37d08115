"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.llm.common import checkpoint, let, pick

#: Lines are paragraphs; longer ones are cut after so many code points.
PARAGRAPH = "[^\\n]{1,512}"
#: Cells of the fingerprint itself, and what a retry takes per paragraph of both texts together.
CELLS, RETRIES = 48, (2.0, 4.0)
HASHES = 3
ROUNDS = 24
#: Rows of a window that finds each document's neighbour, and about the most windows (the driver holds their first places).
BLOCK_ROWS, MOST_BLOCKS = 2048, 1 << 16


def paragraph_digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs; empty for a null or empty text."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.hash(digest, F.lit(7))


def _cell_of(digest: Column, r: int, cells: Column) -> Column:
    """The cell of hash function ``r``; each has a third of the cells to itself."""
    third = (cells / HASHES).cast("int")
    return F.pmod(F.xxhash64(digest, F.lit(r)), third).cast("int") + third * r


CELL = "struct<cell:int,n:int,id:bigint,check:int>"


def _joined(a: Column, b: Column, sign: int = 1) -> Column:
    """Two contents of one cell together; ``sign`` -1 takes the second's count away."""
    return F.struct(
        a["cell"].alias("cell"), (a["n"] + b["n"] * sign).alias("n"), a["id"].bitwiseXOR(b["id"]).alias("id"), a["check"].bitwiseXOR(b["check"]).alias("check")
    )


def _gathered(entries: Column) -> Column:
    """Contents summed by cell, in cell order, without the cells that hold nothing: entries are sorted
    once and folded, so a sketch costs as much as it has paragraphs, however many cells it has."""

    def step(state: Column, x: Column) -> Column:
        same = F.struct(state["done"].alias("done"), _joined(state["open"], x).alias("open"))
        return F.when(state["open"]["cell"] == x["cell"], same).otherwise(
            F.struct(F.concat(state["done"], F.array(state["open"])).alias("done"), x.alias("open"))
        )

    none = F.struct(F.lit(-1).alias("cell"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("id"), F.lit(0).alias("check"))
    start = F.struct(F.array().cast(f"array<{CELL}>").alias("done"), none.alias("open"))

    def ordered(e: Column) -> Column:
        # plain numbers sort much faster than structs: the cell, and below it the entry's place
        places = F.sort_array(F.transform(e, lambda x, i: F.shiftleft(x["cell"].cast("long"), 32) + i))
        return F.transform(places, lambda k: F.get(e, k.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")))

    folded = F.aggregate(let(entries, ordered), start, step, lambda s: F.concat(s["done"], F.array(s["open"])))
    return F.filter(folded, lambda c: (c["n"] != 0) | (c["id"] != 0) | (c["check"] != 0))


def _entries(items: Column, cells: Column) -> Column:
    """One cell content for each of ``items`` (id, check, sign) and hash function."""
    def placed(x: Column) -> Column:
        return F.array(
            *(F.struct(_cell_of(x["id"], r, cells).alias("cell"), x["sign"].alias("n"), x["id"].alias("id"), x["check"].alias("check")) for r in range(HASHES))
        )

    return F.flatten(F.transform(items, placed))


def _items(digests: Column, sign: int) -> Column:
    return F.transform(digests, lambda d: F.struct(d.alias("id"), _check(d).alias("check"), F.lit(sign).alias("sign")))


def sketch(digests: Column, cells: Column) -> Column:
    """array<CELL>: of the cells that digests hash to, how many do, and the xor of them and of their checks."""
    return _gathered(_entries(_items(digests, 1), cells))


def difference(a: Column, b: Column, cells: Column) -> Column:
    """What ``subtract`` makes of the sketches of two digest sets, in one go: sketches are linear."""
    return _gathered(_entries(F.concat(_items(a, 1), _items(b, -1)), cells))


def subtract(a: Column, b: Column) -> Column:
    """The sketch of what only one of two sketches holds: what both hold cancels."""
    minus = F.transform(b, lambda c: F.struct(c["cell"].alias("cell"), (-c["n"]).alias("n"), c["id"].alias("id"), c["check"].alias("check")))
    return _gathered(F.concat(a, minus))


def peel(left: Column, cells: Column) -> Column:
    """array<struct<id, check, sign>> of the digests in which two sketches differ (sign 1: only in the
    first), or null if it can't be told from so few cells. A cell with one digest left (count 1 or -1, fitting
    check) gives it away; taking those digests out of their other cells frees more, round by round."""

    def lone(state: Column) -> Column:
        alone = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["id"])))
        return F.array_distinct(F.transform(alone, lambda c: F.struct(c["id"].alias("id"), c["check"].alias("check"), c["n"].alias("sign"))))

    def out(items: Column) -> Column:
        return F.transform(items, lambda x: F.struct(x["id"].alias("id"), x["check"].alias("check"), (-x["sign"]).alias("sign")))

    def taken(state: Column, found: Column) -> Column:
        left = _gathered(F.concat(state["cells"], _entries(out(found), cells)))
        return F.struct(left.alias("cells"), F.concat(state["found"], found).alias("found"), F.lit(True).alias("more"))

    def still(state: Column) -> Column:
        return F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("more"))

    def again(state: Column, _: Column) -> Column:
        return F.when(
            state["more"], let(lone(state), lambda found: F.when(F.size(found) > 0, taken(state, found)).otherwise(still(state)))
        ).otherwise(state)

    nothing = F.array().cast("array<struct<id:bigint,check:int,sign:int>>")
    start = F.struct(left.alias("cells"), nothing.alias("found"), F.lit(True).alias("more"))
    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, again)
    return let(rounds, lambda s: F.when(F.size(s["cells"]) == 0, s["found"]))


def differing(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """How many digests two texts differ in: first from the fingerprints' cells, then from larger
    sketches of both, sized by the number of paragraphs. Should even the largest not peel, which
    takes digests that collide in all cells, the digest sets are compared."""
    # with nearly every cell taken there is hardly a lone digest to begin with
    small = let(subtract(sketch_a, sketch_b), lambda d: F.when(F.size(d) <= int(0.9 * CELLS), F.size(peel(d, F.lit(CELLS)))))

    def attempt(factor: float) -> Column:
        cells = (F.ceil((F.size(a) + F.size(b)) * F.lit(factor / HASHES)) + 8).cast("int") * HASHES
        return let(cells, lambda m: F.size(peel(difference(a, b, m), m)))

    known = lambda n: F.when(n >= 0, n)  # noqa: E731  size of null is -1 or null
    exact = F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))
    return F.coalesce(let(small, known), *(let(attempt(f), known) for f in RETRIES), exact)


def likeness(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """Jaccard similarity of the paragraph sets, from set sizes and difference; two empty texts are alike."""
    both = F.size(a) + F.size(b)
    return let(
        differing(a, b, sketch_a, sketch_b), lambda d: F.when(both + d == 0, F.lit(1.0)).otherwise((both - d).cast("double") / (both + d).cast("double"))
    )


def fingerprint(cells: Column) -> Column:
    """A sketch as text: base64 of 20 bytes per cell that holds something (cell, count, xor of digests, xor of checks)."""
    def pad(value: Column, digits: int) -> Column:
        return F.lpad(F.hex(value), digits, "0")

    def low(value: Column) -> Column:
        return value.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))

    packed = F.transform(cells, lambda c: F.concat(pad(c["cell"], 8), pad(low(c["n"]), 8), pad(c["id"], 16), pad(low(c["check"]), 8)))
    return F.base64(F.unhex(F.array_join(packed, "")))


def _place(doc_id: Column, digest: Column) -> Column:
    """What rows are ordered by: descending doc_id, none last, then the hash of the text. The complement turns
    the order of ids around for every 64-bit id."""
    return F.struct(doc_id.isNull().cast("int").alias("none"), F.coalesce(F.bitwise_not(doc_id), F.lit(0).cast("long")).alias("down"), digest.alias("digest"))


def _cut_places(keys: DataFrame, most: int) -> list[tuple[int, int, int]]:
    """The first place of each block, in order: blocks hold rows of ``keys`` (place, n) until ``most`` are
    reached, and begin afresh with each partition of the sorted keys, so no task numbers all of them."""
    parts = keys.orderBy("place").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("part").orderBy("place")
    before = F.coalesce(F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = parts.withColumn("before", before).withColumn("last", F.lag("before").over(inside))
    starts = numbered.where(F.col("last").isNull() | (F.floor(F.col("before") / most) > F.floor(F.col("last") / most)))
    return sorted(tuple(r) for r in starts.select("place.none", "place.down", "place.digest").collect())


def _block_of(place: Column, cuts: list[tuple[int, int, int]]) -> Column:
    """struct<block, head>: how many of ``cuts`` are at or before ``place``, and whether it is the last of them; a binary search."""
    lists = [F.split(F.lit(",".join(str(c[i]) for c in cuts)), ",").cast(f"array<{kind}>") for i, kind in enumerate(("int", "bigint", "bigint"))]
    strides = F.array(*(F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))))

    def cut(i: Column) -> Column:
        return F.struct(*(F.get(x, i - 1).alias(n) for x, n in zip(lists, ("none", "down", "digest"), strict=True)))

    def found(p: Column) -> Column:
        block = F.aggregate(strides, F.lit(0), lambda at, stride: F.when((at + stride <= len(cuts)) & (cut(at + stride) <= p), at + stride).otherwise(at))
        return let(block, lambda b: F.struct(b.alias("block"), (cut(b) == p).alias("head")))

    return let(place, found)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with digests, sketch and ``next``: text, digests and sketch of the document next in
    descending doc_id, the first one's for the last. Equal ids follow one another by hash of the text; rows without id come last.

    Rows are cut by their place in this order into blocks of fewer than 2 * ``BLOCK_ROWS`` rows (more only
    beyond ``MOST_BLOCKS`` blocks), and a window runs in each block; copies of the next block's head close it.
    Neither the spread of ids nor a hot id matters. More than ``BLOCK_ROWS`` rows with one id and one text
    are one row to the windows; each of the others is followed by its like.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = checkpoint(rows.groupBy("doc_id", F.xxhash64("text").alias("digest")).agg(F.count(F.lit(1)).alias("n")))
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    most = max(BLOCK_ROWS, -(-total // MOST_BLOCKS))
    place = _place(F.col("doc_id"), F.col("digest"))
    cuts = _cut_places(keys.select(place.alias("place"), F.when(F.col("n") > most, F.lit(1)).otherwise(F.col("n")).alias("n")), most) or [(0, 0, 0)]
    repeats = None
    hot = keys.where(F.col("n") > most).select(F.col("doc_id").alias("hot_id"), F.col("digest").alias("hot_digest"))
    if not hot.isEmpty():
        same = F.col("doc_id").eqNullSafe(F.col("hot_id")) & (F.xxhash64("text") == F.col("hot_digest"))
        single = checkpoint(rows.join(F.broadcast(hot), same, "left_semi").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n")))
        rows = rows.join(F.broadcast(hot), same, "left_anti").unionByName(single.select("doc_id", "text"))
        chunk = single.where("n > 1").select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 2) / most))).alias("chunk")).repartition("doc_id", "chunk")
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(most), F.col("n") - 1 - F.col("chunk") * most)))
        repeats = chunk.select("doc_id", "text", copies.alias("copy")).drop("copy")
    found = rows.withColumn("at", _block_of(_place(F.col("doc_id"), F.xxhash64("text")), cuts))
    # a block's head also closes the block before; the first one's closes the last
    before = F.when(F.col("at.block") > 1, F.col("at.block") - 1).otherwise(F.lit(len(cuts)))
    here, there = (F.struct(b.alias("block"), F.lit(c).alias("closing")) for b, c in ((F.col("at.block"), False), (before, True)))
    every = found.select("doc_id", "text", F.explode(F.when(F.col("at.head"), F.array(here, there)).otherwise(F.array(here))).alias("in"))

    def made(r: DataFrame) -> DataFrame:
        # every row carries its digests and sketch, so the neighbour's needn't be made again
        return r.withColumn("own", paragraph_digests(F.col("text"))).withColumn("cells", sketch(F.col("own"), F.lit(CELLS)))

    after = F.struct("text", "own", "cells")
    order = Window.partitionBy("block").orderBy("closing", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    led = made(every.select("doc_id", "text", "in.block", "in.closing")).withColumn("next", F.lead(after).over(order))
    out = led.where(~F.col("closing")).select("doc_id", "text", "own", "cells", "next")
    if repeats is None:
        return out
    return out.unionByName(made(repeats).select("doc_id", "text", "own", "cells", after.alias("next")))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    The edited text is the text with its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document. A null or empty text has the fingerprint without paragraphs; two
    such are alike (1.0). Equal texts have equal fingerprints. A single row is its own neighbour; an empty
    table gives no rows.
    """
    plain = pick(docs, key, text).toDF("doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    half = F.floor(F.length("text") / F.lit(2)).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr(F.col("next.text"), F.lit(1), half))
    rows = with_next(plain).select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), "own", "cells", "next.own", "next.cells")
    rows = rows.toDF("doc_id", "n_chars", "edited", "own", "cells", "next_own", "next_cells")

    def compared(r: Column) -> Column:
        def result(changed: Column) -> Column:
            return F.struct(
                fingerprint(r["cells"]).alias("fingerprint"), fingerprint(changed).alias("edited_fingerprint"),
                likeness(r["own"], r["edited"], r["cells"], changed).alias("near_edited"),
                likeness(r["own"], r["next"], r["cells"], r["next_cells"]).alias("near_next"),
            )

        return let(sketch(r["edited"], F.lit(CELLS)), result)

    digests = F.struct("own", "cells", paragraph_digests(F.col("edited")).alias("edited"), F.col("next_own").alias("next"), "next_cells")
    out = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), let(digests, compared).alias("r"))
    return out.select(F.col("doc_id").alias(key), "n_chars", "edited_sha256", "r.fingerprint", "r.edited_fingerprint", "r.near_edited", "r.near_next")
