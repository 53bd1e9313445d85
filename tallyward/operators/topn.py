"""Top-N per window and the text report made from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.functions.timing import stamp_text


def top_n(counts: DataFrame, n: int, tie: Sequence[str], by: str = "window_end", score: str = "cnt") -> DataFrame:
    """The ``n`` rows with the highest score per ``by``; ties go to the smaller ``tie`` columns.

    ``row_number() <= n`` lets Spark keep only ``n`` rows per window in each map task before the shuffle,
    so a window with very many keys does not load one task.
    """
    order = Window.partitionBy(by).orderBy(F.desc(score), *[F.asc(c) for c in tie])
    return counts.withColumn("row_num", F.row_number().over(order)).filter(F.col("row_num") <= n)


@dataclass(frozen=True)
class ReportStyle:
    """Texts of a ranking report."""

    title: str
    rank_end: str
    label: str
    score_label: str
    footer: str


# The report texts for ranked items and for ranked pages.
ITEM_REPORT = ReportStyle(
    title="窗口结束时间：",
    rank_end=": ",
    label="\t 商品ID = ",
    score_label="\t 热门度 = ",
    footer="\n ================================= \n\n",
)
PAGE_REPORT = ReportStyle(
    title="窗口结束时间：",
    rank_end=":",
    label="\t 页面 URL = ",
    score_label="\t 热门度 = ",
    footer="\n =================================== \n\n",
)


def ranking_report(ranked: DataFrame, key: str, style: ReportStyle) -> DataFrame:
    """One text per window from ``top_n`` rows: ``window_end, report``. A group has at most N rows."""
    line = F.concat(
        F.lit("NO."),
        F.col("row_num").cast("string"),
        F.lit(style.rank_end),
        F.lit(style.label),
        F.col(key).cast("string"),
        F.lit(style.score_label),
        F.col("cnt").cast("string"),
        F.lit("\n"),
    )
    lines = ranked.groupBy("window_end").agg(
        F.array_sort(F.collect_list(F.struct("row_num", line.alias("line")))).alias("_lines")
    )
    return lines.select(
        "window_end",
        F.concat(
            F.lit(style.title),
            stamp_text("window_end"),
            F.lit("\n"),
            F.array_join(F.col("_lines.line"), ""),
            F.lit(style.footer),
        ).alias("report"),
    )
