"""Raster operators over a pixel table (img, y, x, v): windows, positional joins and grouped statistics.

An image's rows are one window partition, its lines the unit of most operators, so images are the parallelism: at
scale many images share a task and none needs more than its own pixels. A table has one row a pixel; pixels may be
missing, and a neighbour is the pixel whose coordinate differs by one, not the next one that there is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sobel magnitudes of a strong source edge and of a render edge that keeps it.
STRONG_EDGE, KEPT_EDGE = 80, 60
#: Share of equal pixels that makes a wraparound, its least period and least overlap.
WRAP_MATCH, MIN_PERIOD, MIN_SPAN = 0.999, 320, 64
TRANSPARENT = 0xFFFFFFFF


def colour_key(r: Column, g: Column, b: Column, a: Column) -> Column:
    """RGB as one number; one value for all transparent pixels."""
    return F.when(a == 0, F.lit(TRANSPARENT).cast("long")).otherwise((r * 65536 + g * 256 + b).cast("long"))


def luminance(r: Column, g: Column, b: Column) -> Column:
    return F.floor((299 * r + 587 * g + 114 * b) / 1000).cast("int")


def rows_of(img: str = "img") -> Window:
    return Window.partitionBy(img, "y").orderBy("x")


def columns_of(img: str = "img") -> Window:
    return Window.partitionBy(img, "x").orderBy("y")


def statistics(px: DataFrame, *by: str, value: str = "v", mask: Column | None = None) -> DataFrame:
    """(by, n, total, squares, mean, std) over the pixels that mask marks; std is that of the population."""
    v = F.col(value) if mask is None else F.when(mask, F.col(value))
    sums = px.groupBy(*by).agg(F.count(v).alias("n"), F.sum(v.cast("long")).alias("total"), F.sum((v * v).cast("long")).alias("squares"))
    mean = F.col("total") / F.col("n")
    variance = (F.col("n") * F.col("squares") - F.col("total") * F.col("total")) / (F.col("n") * F.col("n"))
    return sums.withColumns({"mean": mean, "std": F.sqrt(variance)})


def transferred(px: DataFrame, guide: DataFrame, by: str, strength: float = 1.0, flat: float = 1e-6) -> DataFrame:
    """px with moved: v brought towards the guide's mean and spread, by strength; a flat image keeps its spread."""
    own = statistics(px, by).select(by, F.col("mean").alias("m"), F.col("std").alias("s"))
    to = statistics(guide, by).select(by, F.col("mean").alias("tm"), F.col("std").alias("ts"))
    gain = F.when(F.col("s") > flat, F.col("ts") / F.col("s")).otherwise(1.0)
    moved = (F.col("v") - F.col("m")) * gain + F.col("tm")
    return px.join(own, by).join(to, by).withColumn("moved", F.col("v") + strength * (moved - F.col("v"))).drop("m", "s", "tm", "ts")


def box_sums(px: DataFrame, factor: int, *by: str) -> DataFrame:
    """(by, y, x, total, n): the pixels of each factor by factor box."""
    cell = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    return px.groupBy(*by, cell("y"), cell("x")).agg(F.sum("v").alias("total"), F.count("*").alias("n"))


def enlarged(px: DataFrame, factor: int) -> DataFrame:
    """Each pixel as a factor by factor box."""
    spread = lambda c: F.explode(F.sequence(F.col(c) * factor, F.col(c) * factor + factor - 1)).alias(c)
    rest = [c for c in px.columns if c != "x"]
    wide = px.select(*rest, spread("x"))
    return wide.select(*[c for c in wide.columns if c != "y"], spread("y")).select(*px.columns)


def _neighbour(c: str, along: str, step: int, w: Window) -> Column:
    """The value of c one place further along a line, null where there is no such pixel."""
    near = (F.lag if step < 0 else F.lead)(F.struct(F.col(along).alias("at"), F.col(c).alias("value"))).over(w)
    return F.when(near["at"] == F.col(along) + step, near["value"])


def _with_gaps(px: DataFrame, value: str, img: str) -> DataFrame:
    """px with w, c, e, the value to the left, here and to the right, and the empty places beside a pixel (here: false).

    A place is empty if no pixel of its line has its coordinate; one between two pixels is listed once.
    """
    side = lambda f, n: f(F.struct(F.col("x").alias("at"), F.col(value).alias("value")), n).over(rows_of(img))
    x, v = F.col("x"), F.col(value)
    here = lambda s, at: F.when(s["at"] == at, s["value"])
    cell = lambda at, w, c, e, real: F.struct(at.alias("x"), w.alias("w"), c.alias("c"), e.alias("e"), F.lit(real).alias("here"))
    none = F.when(F.lit(False), v)
    before, after = F.col("__before"), F.col("__after")
    own = cell(x, here(before, x - 1), v, here(after, x + 1), True)
    right = F.when(after.isNull() | (after["at"] > x + 1), cell(x + 1, v, none, here(after, x + 2), False))
    left = F.when(before.isNull() | (before["at"] < x - 2), cell(x - 1, none, none, v, False))
    sides = px.withColumns({"__before": side(F.lag, 1), "__after": side(F.lead, 1)})
    cells = F.explode(F.filter(F.array(own, right, left), lambda c: c.isNotNull())).alias("__cell")
    return sides.select(*[c for c in px.columns if c != "x"], cells).select(*[c for c in px.columns if c != "x"], "__cell.*")


def sobel(px: DataFrame, img: str = "img", replicate: bool = True) -> DataFrame:
    """px with gx, gy and gg = gx * gx + gy * gy.

    With replicate a pixel stands for a missing neighbour to its left or right, and its line for one that has no pixel
    above or below it: borders are repeated. Without, missing pixels count as 0, wherever they are. Whole
    numbers are worked out as longs: squares leave the range of int at sums over 46,340.
    """
    c = columns_of(img)
    if replicate:
        r = rows_of(img)
        beside = lambda step: F.coalesce(_neighbour("v", "x", step, r), F.col("v"))
        flat = px.withColumns({"w": beside(-1), "e": beside(1), "c": F.col("v"), "here": F.lit(True)})
    else:
        flat = _with_gaps(px, "v", img)
        flat = flat.withColumns({n: F.coalesce(n, F.lit(0)) for n in "wce"})
    flat = flat.withColumns({n: F.col(n) + F.lit(0).cast("long") for n in "wce"})
    flat = flat.withColumns({"dx": F.col("e") - F.col("w"), "sx": F.col("e") + 2 * F.col("c") + F.col("w")})
    side = lambda name, step: F.coalesce(_neighbour(name, "y", step, c), F.col(name) if replicate else F.lit(0))
    out = flat.withColumns({"gx": side("dx", -1) + 2 * F.col("dx") + side("dx", 1), "gy": side("sx", 1) - side("sx", -1)})
    return out.where("here").select(*px.columns, "gx", "gy", (F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")).alias("gg"))


def grown(px: DataFrame, flag: str, img: str = "img") -> DataFrame:
    """px with the boolean flag grown by one pixel in every direction; missing pixels have no flag."""
    across = _with_gaps(px, flag, img).withColumn(flag, F.greatest("w", "c", "e"))
    near = columns_of(img).rangeBetween(-1, 1)
    return across.withColumn(flag, F.max(flag).over(near)).where("here").select(*px.columns)


def kept_share(strong: Column, kept: Column, least: int = 1) -> Column:
    """Share of the strong pixels that are kept, an aggregate; 1 with fewer than least strong ones."""
    n = F.count_if(strong)
    return F.when(n < max(1, least), F.lit(1.0)).otherwise(F.count_if(strong & kept) / n)


def edge_maps(source: DataFrame, render: DataFrame, img: str = "img", strong: float = STRONG_EDGE, kept: float = KEPT_EDGE) -> DataFrame:
    """(img, y, x, strong, kept): strong edges of source, and whether render has an edge within one pixel."""
    a = sobel(source, img).select(img, "y", "x", (F.col("gg") > strong * strong).alias("strong"))
    b = grown(sobel(render, img).withColumn("kept", F.col("gg") > kept * kept), "kept", img).select(img, "y", "x", "kept")
    return a.join(b, [img, "y", "x"])


def column_steps(px: DataFrame, img: str = "img") -> DataFrame:
    """(img, x, step_total, n): summed distance of each column's pixels from those just before them."""
    step = px.withColumn("before", _neighbour("v", "x", -1, rows_of(img)))
    return step.where("before IS NOT NULL").groupBy(img, "x").agg(F.sum(F.abs(F.col("v") - F.col("before"))).alias("step_total"), F.count("*").alias("n"))


def seam_ratio(steps: DataFrame, at: int, band: int, img: str = "img", cap: float = 999.0) -> DataFrame:
    """(img, ratio): the step into column at over the median step within band columns of it."""
    near = steps.where(F.col("x").between(at - band, at + band)).withColumn("step", F.col("step_total") / F.col("n"))
    found = near.groupBy(img).agg(F.max(F.when(F.col("x") == at, F.col("step"))).alias("step"), F.median(F.when(F.col("x") != at, F.col("step"))).alias("base"))
    base = F.coalesce("base", F.lit(0.0))
    ratio = F.when(base == 0, F.when(F.col("step") == 0, 0.0).otherwise(cap)).otherwise(F.round(F.least(F.col("step") / base, F.lit(cap)), 3))
    return found.where("step IS NOT NULL").select(img, ratio.alias("ratio"))


def flat_run(px: DataFrame, along: str, ascending: bool = True, img: str = "img") -> DataFrame:
    """(img, run): how many leading lines are each one value, the same throughout; along: the axis of the lines, x or y."""
    lines = px.groupBy(img, along).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    order = F.col(along).asc() if ascending else F.col(along).desc()
    w = Window.partitionBy(img).orderBy(order)
    same = (F.col("low") == F.col("high")) & (F.col("low") == F.first("low").over(w)) & (F.first("low").over(w) == F.first("high").over(w))
    flagged = lines.withColumn("same", same)
    return flagged.withColumn("all_same", F.bool_and("same").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy(img).agg(F.count_if("all_same").alias("run"))


def wrap_period(px: DataFrame, content_end: int, img: str = "img", least: int = MIN_PERIOD, span: int = MIN_SPAN, match: float = WRAP_MATCH) -> DataFrame:
    """(img, period): the smallest period at which the columns up to content_end repeat those from the start.

    Columns are compared first, by hash: two whole columns of other hashes differ in a pixel at least, which rules out
    most periods. Only for the others do pixels meet, by an equi-join on the column that they would repeat.
    """
    inside = px.where(F.col("x") < content_end).select(img, "y", "x", "v")
    columns = inside.groupBy(img, "x").agg(F.count("*").alias("n"), F.min("y").alias("top"), F.max("y").alias("bottom"), F.sum(F.xxhash64("y", "v").cast("decimal(38,0)")).alias("hash"))
    repeated = lambda t: t.where(F.col("x") >= least).withColumn("period", F.explode(F.sequence(F.lit(least), F.least(F.col("x"), F.lit(content_end - span)))))
    far = repeated(columns).select(img, (F.col("x") - F.col("period")).alias("x"), "period", *[F.col(c).alias(f"far_{c}") for c in ("n", "top", "bottom", "hash")])
    whole = lambda p: F.col(f"{p}n") == F.col(f"{p}bottom") - F.col(f"{p}top") + 1
    other = whole("") & whole("far_") & (F.col("top") == F.col("far_top")) & (F.col("bottom") == F.col("far_bottom")) & (F.col("hash") != F.col("far_hash"))
    possible = columns.join(far, [img, "x"]).groupBy(img, "period").agg(F.count_if(other).alias("others"), F.sum(F.least("n", "far_n")).alias("pixels"))
    possible = possible.where(F.col("others") <= (1 - match) * F.col("pixels") + 1e-6).select(img, "period")
    met = inside.join(possible, img).where(F.col("x") >= F.col("period")).select(img, "y", (F.col("x") - F.col("period")).alias("x"), F.col("v").alias("far"), "period")
    shares = inside.join(met, [img, "y", "x"]).groupBy(img, "period").agg(F.avg((F.col("v") == F.col("far")).cast("int")).alias("share"))
    return shares.where(F.col("share") >= match).groupBy(img).agg(F.min("period").alias("period"))


def differs(objects: DataFrame, rooms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, differs): whether any opaque object pixel (keys, room, ox, oy, y, x, v) differs from the room (room, y, x, v) beneath."""
    beneath = rooms.select(F.col("room"), F.col("y").alias("ry"), F.col("x").alias("rx"), F.col("v").alias("rv"))
    placed = objects.withColumns({"ry": F.col("y") + F.col("oy"), "rx": F.col("x") + F.col("ox")})
    return placed.join(beneath, ["room", "ry", "rx"], "left").groupBy(*keys).agg(F.bool_or((F.col("v") != TRANSPARENT) & ~F.col("v").eqNullSafe(F.col("rv"))).alias("differs"))


def stitched(renders: DataFrame, img: str = "img") -> DataFrame:
    """(img, y, x, v): of the windows' renders (img, window, from_y, from_x, y, x, v) that reach a pixel, the last one's."""
    return renders.where("y >= from_y AND x >= from_x").groupBy(img, "y", "x").agg(F.max_by("v", "window").alias("v"))


def smoothed(px: DataFrame, distance: int, img: str = "img") -> DataFrame:
    """px with total and n: sum and number of the 3 by 3 neighbours within distance of the pixel.

    Borders are repeated: a pixel stands for a missing neighbour to its left or right, its line for a missing one above
    or below.
    """
    r, c = rows_of(img), columns_of(img)
    beside = lambda step: F.coalesce(_neighbour("v", "x", step, r), F.col("v"))
    wide = px.withColumn("line", F.struct(beside(-1).alias("a"), F.col("v").alias("b"), beside(1).alias("c")))
    wide = wide.withColumns({k: F.coalesce(_neighbour("line", "y", step, c), F.col("line")) for k, step in (("north", -1), ("south", 1))})
    near = [F.col(f"{line}.{at}") for line in ("north", "line", "south") for at in "abc"]
    close = lambda n: F.abs(n - F.col("v")) <= distance
    total = sum((F.when(close(n), n).otherwise(0) for n in near), F.lit(0))
    count = sum((close(n).cast("int") for n in near), F.lit(0))
    return wide.withColumns({"total": total, "n": count}).select(*px.columns, "total", "n")
