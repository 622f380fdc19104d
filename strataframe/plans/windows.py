"""Window plans: overlapping spans over an axis, grids, neighbours, stitch lines and context boxes of a room."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Multiples that spans start at, least overlap, size of a window, growth and least size of a context box.
ALIGN, OVERLAP, WIDTH, HEIGHT = 8, 64, 320, 240
CONTEXT_MARGIN, CONTEXT_MIN = 32, 128
SCALE = 4


def _starts(length: int, size: int, n: int) -> list[int]:
    """Starts of n spans over [0, length): evenly spread, aligned down, the last flush with the end."""
    return [i * (length - size) // (n - 1) // ALIGN * ALIGN for i in range(n - 1)] + [length - size]


def plan_axis(start: int, end: int, size: int, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """The fewest spans of at most size over [start, end) whose neighbours overlap enough."""
    length = end - start
    if length <= size:
        return [(start, end)]
    n = ceil((length - overlap) / (size - overlap))
    while max(_steps(_starts(length, size, n))) > size - overlap:
        n += 1
    return [(start + a, start + a + size) for a in _starts(length, size, n)]


def _steps(starts: list[int]) -> list[int]:
    return [b - a for a, b in zip(starts, starts[1:], strict=False)]


def axis_spans(start: Column, end: Column, size: int, most: int = 64, overlap: int = OVERLAP) -> Column:
    """plan_axis as an expression: the first number of spans, of up to most, whose neighbours overlap enough."""
    length = end - start
    least = F.ceil((length - overlap) / F.lit(size - overlap)).cast("int")
    at = lambda i, n: F.when(i == n - 1, length - size).otherwise(F.floor(F.floor(i * (length - size) / (n - 1)) / ALIGN).cast("int") * ALIGN)
    fits = lambda n: F.forall(F.sequence(F.lit(1), n - 1), lambda i: at(i - 1, n) + size - at(i, n) >= overlap)
    fewest = F.slice(F.filter(F.sequence(least, least + most), fits), 1, 1)
    span = lambda a: F.struct((start + a).cast("int").alias("a"), (start + a + size).cast("int").alias("b"))
    # the number is bound once, not worked out again wherever it is used
    spans = F.flatten(F.transform(fewest, lambda n: F.transform(F.transform(F.sequence(F.lit(0), n - 1), lambda i: at(i, n)), span)))
    return F.when(length <= size, F.array(F.struct(start.cast("int").alias("a"), end.cast("int").alias("b")))).otherwise(spans)


def window_grid(rooms: DataFrame, width: int = WIDTH, height: int = HEIGHT) -> DataFrame:
    """(room, window, x0, x1, y0, y1) for rooms (room, left, right, top, bottom): columns by rows, numbered row by row."""
    spans = rooms.select("room", F.posexplode(axis_spans(F.col("top"), F.col("bottom"), height)).alias("row", "ys"), "left", "right")
    cells = spans.select("room", "row", "ys", F.posexplode(axis_spans(F.col("left"), F.col("right"), width)).alias("col", "xs"))
    number = F.row_number().over(Window.partitionBy("room").orderBy("row", "col")) - 1
    return cells.select("room", number.alias("window"), F.col("xs.a").alias("x0"), F.col("xs.b").alias("x1"), F.col("ys.a").alias("y0"), F.col("ys.b").alias("y1"))


def with_neighbours(windows: DataFrame) -> DataFrame:
    """windows with left_x1 and up_y1, the ends of those before in row and column, and stitch_x, stitch_y."""
    left = F.lag("x1").over(Window.partitionBy("room", "y0").orderBy("x0"))
    up = F.lag("y1").over(Window.partitionBy("room", "x0").orderBy("y0"))
    out = windows.withColumns({"left_x1": left, "up_y1": up})
    middle = lambda near, own: F.when(near.isNull(), own).otherwise(own + F.floor((near - own) / 2)).cast("int")
    return out.withColumns({"stitch_x": middle(F.col("left_x1"), F.col("x0")), "stitch_y": middle(F.col("up_y1"), F.col("y0"))})


def stitch_lines(windows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(room, columns, rows): sorted distinct scaled lines where the stitch switches renders; windows with neighbours."""
    return windows.groupBy("room").agg(
        F.array_sort(F.collect_set(F.when(F.col("left_x1").isNotNull(), F.col("stitch_x") * scale))).alias("columns"),
        F.array_sort(F.collect_set(F.when(F.col("up_y1").isNotNull(), F.col("stitch_y") * scale))).alias("rows"),
    )


def context_span(start: Column, length: Column, whole: Column, margin: int = CONTEXT_MARGIN, least: int = CONTEXT_MIN) -> Column:
    """struct(a, b): the object's span grown by margin, aligned outward, at least least long and inside the padded room."""
    limit = F.ceil(whole / ALIGN) * ALIGN
    a = F.greatest(F.lit(0), F.floor((start - margin) / ALIGN) * ALIGN)
    b = F.least(limit, F.ceil((start + length + margin) / ALIGN) * ALIGN)
    short = F.greatest(F.lit(0), least - (b - a))
    a2 = F.greatest(F.lit(0), a - F.ceil(short / 2 / ALIGN) * ALIGN)
    b2 = F.least(limit, F.greatest(b, a2 + least))
    a3 = F.greatest(F.lit(0), F.least(a2, b2 - least))
    return F.struct(a3.cast("int").alias("a"), b2.cast("int").alias("b"))


def ramp(n: int) -> list[int]:
    """n values strictly between 0 and 255, rising evenly."""
    return [round(i * 255 / (n + 1)) for i in range(1, n + 1)]
