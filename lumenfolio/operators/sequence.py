"""Repair of printed page numbers along scans, and runs, groups and windows of ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .pages import EXTENSION, TRUSTED

LAYOUT = "tesseract_tsv_line"
VISIBLE = ("visible_ocr_candidate", "visible_layout_candidate")


def best_candidate(candidates: Column, trusted: Column, most: int = 500) -> Column:
    """Of struct(value, zone, raw, script, source, avg_conf) on a trusted page the best by
    source, script, zone, confidence and length; the earlier of equal ones."""
    ok = F.filter(candidates, lambda c: c["value"].between(1, most))
    flag = lambda c: F.when(c, 1).otherwise(0)
    ranked = F.transform(
        ok,
        lambda c, i: F.struct(
            flag(c["source"] == LAYOUT).alias("a"),
            flag(c["script"] == "bangla").alias("b"),
            flag(c["zone"] == "bottom").alias("c"),
            F.coalesce(c["avg_conf"], F.lit(0.0)).alias("d"),
            F.length(F.coalesce(c["raw"], F.lit(""))).alias("e"),
            (-i).alias("f"),
            c.alias("own"),
        ),
    )
    return F.when(trusted, F.array_max(ranked)["own"])


def merge_candidates(own: Column, layout: Column) -> Column:
    """Own candidates, then those of the layout that differ in value, zone, source or raw text."""
    same = lambda a, b: a["value"].eqNullSafe(b["value"]) & a["zone"].eqNullSafe(b["zone"]) & a["source"].eqNullSafe(b["source"]) & a["raw"].eqNullSafe(b["raw"])
    added = F.filter(layout, lambda c: ~F.exists(own, lambda o: same(o, c)))
    return F.when(layout.isNull(), own).otherwise(F.concat(own, added))


def supported_offsets(candidates: DataFrame) -> DataFrame:
    """book_id, offset of the offsets (value - scan_page) that at least three scans support.

    Where several are supported and the best has twice the second's scans, it alone.
    Counts are pre-aggregated; a book has few offsets.
    """
    seen = candidates.groupBy("book_id", (F.col("value") - F.col("scan_page")).alias("offset")).agg(F.count("*").alias("scans"), (F.max("scan_page") - F.min("scan_page")).alias("span"))
    w = Window.partitionBy("book_id").orderBy(F.col("scans").desc(), F.col("span").desc(), F.abs("offset"), "offset")
    ranked = seen.where("scans >= 3").withColumn("rank", F.row_number().over(w)).withColumn("second", F.lead("scans").over(w))
    first = ranked.withColumn("alone", F.first(F.col("second").isNotNull() & (F.col("scans") >= 2 * F.col("second"))).over(w))
    return first.where("rank = 1 OR NOT alone").select("book_id", "offset")


def nonmonotonic(candidates: DataFrame) -> DataFrame:
    """The rows and whether their value is out of order with the raw neighbours."""
    w = Window.partitionBy("book_id").orderBy("scan_page")
    before, after = F.lag("value").over(w), F.lead("value").over(w)
    return candidates.withColumn("rejected", F.coalesce(F.col("value") <= before, F.lit(False)) | F.coalesce(F.col("value") >= after, F.lit(False)))


def repair(pages: DataFrame) -> DataFrame:
    """Printed numbers of the pages of all books, with basis, confidence and flags.

    Needs book_id, scan_page, page_type, ``value`` (the best candidate's, or
    null), ``source`` (its source) and footer (text). The order is: reject by
    supported offsets (W2) or else by neighbours (W3); assign; fill runs of
    trusted pages by offset (W5); then, from the visible anchors, one anchor's
    footer tail (W7), gaps (W4), and the leading and trailing ends (W6). All
    of it is window functions per book: no UDF, and one sort that all share.
    """
    by_book = Window.partitionBy("book_id")
    w = by_book.orderBy("scan_page")
    # what follows is what came before in the other order: a frame that only grows, where one that shrinks is summed anew for each page of a book
    up, down = (by.rowsBetween(Window.unboundedPreceding, -1) for by in (w, by_book.orderBy(F.col("scan_page").desc())))
    t = pages.withColumn("idx", F.row_number().over(w) - 1).withColumn("trusted", F.col("page_type").isin(*TRUSTED))
    cand = t.where("trusted AND value IS NOT NULL").select("book_id", "scan_page", "value")
    offsets = supported_offsets(cand).groupBy("book_id").agg(F.array_sort(F.collect_list("offset")).alias("offsets"))
    bad = nonmonotonic(cand).select("book_id", "scan_page", F.col("rejected").alias("out_of_order"))
    t = t.join(offsets, "book_id", "left").join(bad, ["book_id", "scan_page"], "left")
    has = F.col("trusted") & F.col("value").isNotNull()
    offset = F.col("value") - F.col("scan_page")
    t = t.withColumn("rejected", has & F.coalesce(~F.array_contains("offsets", offset), F.col("out_of_order")))
    visible = has & ~F.col("rejected")
    t = t.withColumns({
        "anchor": F.when(visible, F.col("value")),
        "base": F.when(F.col("rejected"), "suspect_visible_candidate").when(has, F.when(F.col("source") == LAYOUT, VISIBLE[1]).otherwise(VISIBLE[0])).otherwise("missing"),
        "has": has,
    })
    # A run of trusted pages, and the offsets that its anchors have
    t = t.withColumn("run", F.sum(F.when(F.col("trusted"), 0).otherwise(1)).over(w))
    in_run = Window.partitionBy("book_id", "run")
    t = t.withColumn("run_offsets", F.collect_set(F.when(F.col("anchor").isNotNull() & F.col("offsets").isNotNull() & F.col("trusted"), offset)).over(in_run))
    fits = F.array_sort(F.filter("run_offsets", lambda o: F.col("scan_page") + o >= 1))
    t = t.withColumn("by_offset", F.when(F.col("trusted") & F.col("anchor").isNull(), F.col("scan_page") + F.get(fits, F.lit(0))))
    t = t.withColumn("after5", F.coalesce("anchor", "by_offset"))
    # neighbours among the anchors
    place = F.when(F.col("anchor").isNotNull(), F.struct("idx", F.col("anchor").alias("page")))
    t = t.withColumns({
        "left": F.last(place, True).over(up),
        "right": F.last(place, True).over(down),
        "anchors": F.count("anchor").over(by_book),
        "nth": F.count("anchor").over(w),
        "p": place,
    })
    t = t.withColumns({
        "first1": F.min(F.when(F.col("nth") == 1, F.col("p"))).over(by_book),
        "first2": F.min(F.when(F.col("nth") == 2, F.col("p"))).over(by_book),
        "last1": F.max("p").over(by_book),
        "last2": F.max(F.when(F.col("nth") == F.col("anchors") - 1, F.col("p"))).over(by_book),
    })
    gap = F.col("right.idx") - F.col("left.idx")
    straight = F.col("right.page") - F.col("left.page") == gap
    inside = F.col("anchor").isNull() & (gap > 1) & (F.col("anchors") >= 2)
    in_gap = F.when(inside & straight & F.col("trusted"), F.col("left.page") + F.col("idx") - F.col("left.idx"))
    mismatch = F.when(inside & ~straight, F.concat(F.lit("sequence_gap_mismatch:"), F.col("left.page").cast("string"), F.lit("->"), F.col("right.page").cast("string")))
    t = t.withColumns({"in_gap": in_gap, "mismatch": mismatch})
    # Up to two pages before the first and behind the last anchor, each only if the nearer one was filled
    free = F.col("after5").isNull() & ~F.col("has")
    t = t.withColumns({"lead_ok": free & F.col("page_type").isin(*EXTENSION), "tail_ok": free & F.col("trusted"), "foot": F.lit(False)})
    near = F.col("first1.idx") - F.col("idx")
    leading = F.col("first1.page") - near
    step_lead = (F.col("first2.page") - F.col("first1.page")) == (F.col("first2.idx") - F.col("first1.idx"))
    trusted_lead = F.max(F.when(near.between(1, 2) & F.col("trusted"), 1)).over(by_book) == 1
    lead_fill = F.when((F.col("anchors") >= 2) & step_lead & trusted_lead & F.col("lead_ok") & (leading >= 1) & ((near == 1) | ((near == 2) & F.lead("lead_ok").over(w))), leading)
    far = F.col("idx") - F.col("last1.idx")
    step_tail = (F.col("last1.page") - F.col("last2.page")) == (F.col("last1.idx") - F.col("last2.idx"))
    tail_fill = F.when((F.col("anchors") >= 2) & step_tail & F.col("tail_ok") & ((far == 1) | ((far == 2) & F.lag("tail_ok").over(w))), F.col("last1.page") + far)
    # One anchor; three pages at most; two explicit footers unlock a third page without one
    expected = F.col("last1.page") + far
    t = t.withColumns({"lead_fill": lead_fill, "tail_fill": tail_fill, "far": far, "footed": F.col("tail_ok") & (F.col("anchors") == 1) & far.between(1, 3) & X.footer_has_page(F.col("footer"), expected, extra_digit=True)})
    one, two = F.lag("footed", 1, False).over(w), F.lag("footed", 2, False).over(w)
    foot = F.col("footed") & ((F.col("far") == 1) | ((F.col("far") == 2) & one) | ((F.col("far") == 3) & one & two))
    unlocked = (F.col("anchors") == 1) & (F.col("far") == 3) & ~F.col("footed") & F.col("tail_ok") & one & two
    t = t.withColumns({"foot_fill": F.when(foot, expected), "unlocked": F.when(unlocked, expected)})
    steps = (("by_offset", "sequence_offset_inferred", 0.7), ("foot_fill", "footer_sequence_inferred", 0.62), ("unlocked", "trailing_sequence_inferred", 0.55), ("in_gap", "sequence_inferred", 0.65), ("lead_fill", "leading_sequence_inferred", 0.55), ("tail_fill", "trailing_sequence_inferred", 0.55))
    basis = F.when(F.col("anchor").isNotNull(), F.col("base"))
    sure = F.when(F.col("anchor").isNotNull(), 0.8)
    for name, label, trust in steps:
        basis, sure = basis.when(F.col(name).isNotNull(), label), sure.when(F.col(name).isNotNull(), trust)
    flags = F.array_compact(F.array(
        F.when(F.col("rejected"), F.when(F.col("offsets").isNotNull(), "offset_outlier_printed_page_candidate").otherwise("nonmonotonic_printed_page_candidate")),
        F.when(~F.col("has") & F.col("trusted"), "missing_printed_page_candidate"),
        F.col("mismatch"),
    ))
    return t.select(
        "book_id", "scan_page", "page_type",
        F.coalesce("anchor", *[s[0] for s in steps]).cast("int").alias("printed_page"),
        basis.otherwise(F.col("base")).alias("basis"),
        sure.otherwise(F.when(F.col("rejected"), 0.2).otherwise(0.0)).alias("confidence"),
        F.array_sort(flags).alias("flags"),
    )


def longest_true_run(flags: Column) -> Column:
    """The longest run of true in an array of booleans."""
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("now"))
    step = lambda a, x: F.struct(F.greatest(a["best"], F.when(x, a["now"] + 1).otherwise(0)).alias("best"), F.when(x, a["now"] + 1).otherwise(0).alias("now"))
    return F.aggregate(flags, start, step)["best"]


def longest_integer_run(values: Column) -> Column:
    """The longest run of consecutive integers among the values."""
    start = F.struct(F.lit(0).alias("best"), F.lit(0).alias("now"), F.lit(None).cast("long").alias("last"))

    def step(a: Column, x: Column) -> Column:
        now = F.when(x == a["last"] + 1, a["now"] + 1).otherwise(1)
        return F.struct(F.greatest(a["best"], now).alias("best"), now.alias("now"), x.cast("long").alias("last"))

    return F.aggregate(F.array_sort(F.array_distinct(F.array_compact(values))), start, step)["best"]


def longest_flag_runs(rows: DataFrame, keys: list[str], order: list[str], flag: Column, name: str = "longest") -> DataFrame:
    """W9 over rows: the longest run of rows with the flag of each key, 0 without any; islands by windows, so no key is gathered."""
    w = Window.partitionBy(*keys).orderBy(*order)
    n = F.when(flag, 1).otherwise(0)
    t = rows.withColumn("__f", n).withColumn("__g", F.row_number().over(w) - F.sum("__f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return t.groupBy(*keys, "__g").agg(F.sum("__f").alias("__n")).groupBy(*keys).agg(F.max("__n").cast("int").alias(name))


def longest_number_runs(rows: DataFrame, keys: list[str], value: str, name: str = "longest") -> DataFrame:
    """W10 over rows: the longest run of consecutive integers of each key, repeats counted once."""
    t = rows.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    t = t.withColumn("__g", F.col(value) - F.row_number().over(Window.partitionBy(*keys).orderBy(value)))
    return t.groupBy(*keys, "__g").agg(F.count("*").alias("__n")).groupBy(*keys).agg(F.max("__n").cast("int").alias(name))


def gap_groups(rows: DataFrame, keys: list[str], order: str, gap: int = 1, name: str = "grp") -> DataFrame:
    """A new group where the step to the row before is more than ``gap``."""
    w = Window.partitionBy(*keys).orderBy(order)
    new = F.when(F.col(order) - F.lag(order).over(w) > gap, 1).otherwise(0)
    return rows.withColumn("__new", new).withColumn(name, F.sum("__new").over(w)).drop("__new")


def page_windows(groups: DataFrame, keys: list[str], scan: str = "scan_page", most: int = 4) -> DataFrame:
    """The whole group if it has at most ``most`` pages, else all sub-windows of 1 to ``most`` pages."""
    g = groups.groupBy(*keys).agg(F.array_sort(F.collect_set(scan)).alias("__s"))

    def cut(s: Column) -> Column:
        n = F.size(s)
        starts = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), n - i + 1)), lambda k: F.slice(s, i, k)))
        return F.when(n <= most, F.array(s)).otherwise(F.flatten(starts))

    return g.select(*keys, F.explode(X.let(F.col("__s"), cut)).alias("scans"))


def region_windows(lines: Column, most_lines: int = 3, most_chars: int = 520) -> Column:
    """struct(line_start, line_end, text) of 1 to so many consecutive lines, until the budget of compact characters is passed.

    ``lines`` is an array of struct(line_index, text).
    """
    size = lambda t: F.length(F.replace(t, F.lit(" "), F.lit("")))

    def at(x: Column, i: Column) -> Column:
        part = F.transform(F.sequence(F.lit(1), F.least(F.lit(most_lines), F.size(x) - i)), lambda k: F.slice(x, i + 1, k))
        made = F.transform(part, lambda p: F.struct(F.get(p, F.lit(0))["line_index"].alias("line_start"), F.element_at(p, -1)["line_index"].alias("line_end"), F.array_join(F.transform(p, lambda s: s["text"]), " ").alias("text")))
        return F.filter(made, lambda m: size(m["text"]) <= most_chars)

    every = lambda x: F.flatten(F.transform(F.sequence(F.lit(0), F.size(x) - 1), lambda i: at(x, i)))
    return F.when(F.size(lines) > 0, X.let(lines, every)).otherwise(F.array().cast("array<struct<line_start:int,line_end:int,text:string>>"))


def runner_up(rows: DataFrame, keys: list[str], score: str, ties: list[str]) -> DataFrame:
    """The best row of each group and its lead over the second (null without one)."""
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), *ties)
    ranked = rows.withColumn("runner_up_gap", F.col(score) - F.lead(score).over(w)).withColumn("__rn", F.row_number().over(w))
    return ranked.where("__rn = 1").drop("__rn")


def state_islands(rows: DataFrame, keys: list[str], order: str, opens: Column, continues: Column, gap: int = 1, name: str = "active") -> DataFrame:
    """Rows are active from one that opens, as long as the next ones continue (or open) without a scan gap."""
    w = Window.partitionBy(*keys).orderBy(order)
    broken = F.coalesce(F.col(order) - F.lag(order).over(w) > gap, F.lit(True)) | ~(opens | continues)
    t = rows.withColumn("__o", opens).withColumn("__b", F.when(broken, 1).otherwise(0))
    t = t.withColumn("__g", F.sum("__b").over(w))
    inner = Window.partitionBy(*keys, "__g").orderBy(order)
    seen = F.max(F.when(F.col("__o"), 1).otherwise(0)).over(inner) == 1
    return t.withColumn(name, seen & (opens | continues)).drop("__o", "__b", "__g")


def lines_after(rows: DataFrame, keys: list[str], order: str, hit: str, after: int = 5, tail: int = 5) -> DataFrame:
    """Rows within ``after`` rows behind the last hit of their group, and the group's last ``tail`` rows."""
    by = Window.partitionBy(*keys)
    last = F.max(F.when(F.col(hit), F.col(order))).over(by)
    rank = F.row_number().over(by.orderBy(F.col(order).desc()))
    near = F.coalesce((F.col(order) > last) & (F.col(order) <= last + after), F.lit(False))
    return rows.withColumn("__near", near).withColumn("__rank", rank).where(F.col("__near") | (F.col("__rank") <= tail)).drop("__near", "__rank")


def numbered(rows: DataFrame, order: list[Column | str], name: str, path: str) -> DataFrame:
    """``rows`` with their number in one order of all of them, from 1, without a task that sees all.

    Rows are sorted by range and written to ``path``, a new folder that all
    executors share; each range's rows are numbered by position, and its start
    is the sum of the sizes of those before it, one row a range.
    """
    spark = rows.sparkSession
    cut = rows.orderBy(*order).withColumns({"__range": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    cut.write.parquet(path)
    done = spark.read.schema(cut.schema).parquet(path)
    sizes = done.groupBy("__range").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sizes.select("__range", "__first", before.alias("__before")))  # a row a range of the sort
    return done.join(starts, "__range").withColumn(name, F.col("__before") + F.col("__at") - F.col("__first") + 1).drop("__range", "__at", "__first", "__before")
