"""Shards along a Hilbert curve through several columns.

Every column is quantised into 2**bits cells of about equal numbers of rows, the
cells' numbers are one place on a Hilbert curve, rows are ordered by their places
and the order is cut into runs. Neighbours on the curve are neighbours in every
column, so each shard spans small ranges of all of them and readers can skip
files by any.

All of it is DataFrame expressions. Orders and running sums are split by range;
what the driver sees is the cells' bounds, fewer than 2**bits values a column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.running import running_total
from millrace.session import pinned

BITS = 5
OVERHEAD = 16
LAWS = ("rows", "bytes")
MAX_DIMS = 5


def curve_steps(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state of the curve by state and corner: entry ``state * 2**dims + corner``.

    A state is where the curve enters a cube of 2**dims corners and along which
    axis it leaves; corners are visited in the order of the Gray code, turned and
    mirrored to fit.
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def turned(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & mask

    def axis(i: int) -> int:
        """The axis in which the i-th and the next corner differ."""
        n = 0
        while i >> n & 1:
            n += 1
        return n % dims

    at = {gray(i): i for i in range(size)}
    states, digits, following = [(0, 0)], [], []
    for entry, along in states:  # grows while it is read
        for corner in range(size):
            digit = at[turned(corner ^ entry, -(along + 1))]
            enter = 0 if digit == 0 else gray((digit - 1) // 2 * 2)
            leave = 0 if digit == 0 else axis(digit - 1 if digit % 2 == 0 else digit)
            state = (entry ^ turned(enter, along + 1), (along + leave + 1) % dims)
            if state not in states:
                states.append(state)
            digits.append(digit)
            following.append(states.index(state))
    return digits, following


def hilbert_index(codes: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of cell numbers of ``bits`` bits each."""
    dims = len(codes)
    if not 1 <= dims <= MAX_DIMS or dims * bits > 62:
        raise ValueError(f"1 to {MAX_DIMS} columns of 62 bits together")
    if dims == 1:
        return codes[0].cast("long")
    digits, following = (F.array(*map(F.lit, x)) for x in curve_steps(dims))

    def level(acc: Column, shift: Column) -> Column:
        corner = sum((F.call_function("shiftright", c, shift).bitwiseAND(F.lit(1)) * (1 << k) for k, c in enumerate(codes)), F.lit(0))
        entry = (acc["state"] * (1 << dims) + corner).cast("int")
        return F.struct(F.get(following, entry).alias("state"), (acc["place"] * (1 << dims) + F.get(digits, entry)).alias("place"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, level, lambda acc: acc["place"])


def cell_bounds(df: DataFrame, column: str, cells: int) -> list:
    """Upper bounds, in order, of all cells but the last: about as many rows lie in each.

    Rows are counted per value; a value is never split, so there are fewer cells
    where few values hold most rows. Nulls are left out.
    """
    counts = df.select(F.col(f"`{column}`").alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    running = running_total(counts, [F.col("v")], "n", "upto")
    total = running.agg(F.sum("n")).first()[0]
    if total is None:
        return []
    cell = F.expr(f"cast(cast(upto - 1 as decimal(38)) * {cells} div {total} as int)")
    return sorted(r[0] for r in running.groupBy(cell.alias("c")).agg(F.max("v")).select("max(v)").collect())[:-1]


def cell_of(value: Column, bounds: list) -> Column:
    """The number of bounds below a value; 0 for nulls."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < value))


def shard_documents(
    docs: DataFrame, dims: Sequence[str], count: int, law: str = "rows", bits: int = BITS, doc_id: str = "doc_id", text: str = "text", carry: bool = False
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard, place, and the row itself with ``carry``.

    ``law`` says what is cut evenly: with "rows" the numbers of rows of shards
    0 to ``count`` - 1 differ by one at most, with "bytes" their sizes by the
    largest row at most. ``size`` is the text's UTF-8 bytes and ``OVERHEAD``,
    ``slot`` the gapless number of a row in its shard, ``place`` that on the
    curve; ``grown_shard`` is null, as these laws deal all rows anew for another
    count.

    Rows of one place are ordered by the text's CRC-32, id and size, so equal
    texts of equal columns are neighbours; rows equal in all of these may trade
    slots, which changes nothing but them. Null texts have no bytes, null ids
    come first, null columns lie in the first cell. A text of any length is read
    once, and shuffled only with ``carry``. Fewer rows than shards leave shards
    empty; an empty table gives no rows; other columns are ignored.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {LAWS}")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    place = hilbert_index([cell_of(F.col(f"`{c}`"), cell_bounds(docs, c, 1 << bits)) for c in dims], bits)
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        place.alias("place"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []),
    ).withColumn("_n", F.monotonically_increasing_id())
    # the last key deals equal rows to several tasks too
    order = ["place", "text_crc32", "doc_id", "size", "_n"]
    split = pinned(rows.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id()))
    weight = F.lit(1).cast("long") if law == "rows" else F.col("size")

    # a row for each piece, however many rows there are
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = split.groupBy("_piece").agg(F.sum(weight).alias("w"), F.count("*").alias("c"))
    every = Window.partitionBy(F.lit(0))
    lift = pieces.select("_piece", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("_w"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_c"), F.sum("w").over(every).alias("_all"))
    inner = Window.partitionBy("_piece").orderBy(*order)
    numbered = split.withColumns({"_upto": F.sum(weight).over(inner.rowsBetween(Window.unboundedPreceding, 0)), "_at": F.row_number().over(inner)})
    numbered = numbered.join(F.broadcast(lift), "_piece").withColumn("_number", F.col("_at") + F.col("_c") - 1)
    # the shard in which the middle of the row falls
    middle = (F.col("_upto") + F.col("_w")) * 2 - weight
    numbered = numbered.withColumn("_middle", middle.cast("decimal(38)"))
    numbered = numbered.withColumn("shard", F.expr(f"cast(_middle * {count} div (2 * _all) as int)"))
    firsts = numbered.groupBy("shard").agg(F.min("_number").alias("_first"))
    out = numbered.join(F.broadcast(firsts), "shard")  # a row for each shard
    return out.select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("_number") - F.col("_first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "place", *(["row"] if carry else []),
    )


def write_shards(sharded: DataFrame, path: str, count: int, column: str = "shard") -> str:
    """Write the rows of ``shard_documents(..., carry=True)``, a folder for each shard, in the order of their slots.

    Returns the name of the column that holds the shard: ``column``, with as many
    underscores behind it as keep it apart from the rows' own.
    """
    own = sharded.select("row.*").columns
    while column.lower() in {c.lower() for c in own}:
        column += "_"
    rows = sharded.repartition(count, "shard").sortWithinPartitions("shard", "slot")
    rows.select(F.col("shard").alias(column), *(F.col(f"row.`{c}`") for c in own)).write.partitionBy(column).parquet(path)
    return column


def shard_ranges(spark, path: str, dims: Sequence[str], column: str = "shard") -> DataFrame:
    """Per written shard its number of rows and the least and greatest value of each column, to skip shards by."""
    table = spark.read.parquet(path)
    return table.groupBy(F.col(f"`{column}`").alias("shard")).agg(F.count("*").alias("n_rows"), *(f(f"`{c}`").alias(f"{name}_{c}") for c in dims for name, f in (("min", F.min), ("max", F.max))))
