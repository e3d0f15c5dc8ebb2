"""Text reports over ranked rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.times import bound_text


@dataclass(frozen=True)
class ReportFormat:
    rule: str
    window_label: str
    id_label: str
    count_label: str


# The report texts that readers of the two rankings expect.
ITEM_REPORT = ReportFormat(
    rule="======================",
    window_label="窗口结束时间：",
    id_label="商品ID= ",
    count_label="点击量= ",
)
PAGE_REPORT = ReportFormat(
    rule="==========================================",
    window_label="窗口结束时间：",
    id_label="页面URL= ",
    count_label="页面访问量=",
)


def ranking_report(ranked: DataFrame, id_col: str, count_col: str, fmt: ReportFormat) -> DataFrame:
    """One text per ``window_end`` from rows that carry ``row_num``.

    Expects ranked rows, so each group holds at most the top n.
    """
    line = F.format_string(f"NO%d:{fmt.id_label}%s{fmt.count_label}%d", "row_num", F.col(id_col).cast("string"), count_col)
    return (
        ranked.groupBy("window_end")
        .agg(F.sort_array(F.collect_list(F.struct("row_num", line.alias("line")))).alias("lines"))
        .select(
            "window_end",
            F.concat(
                F.lit(f"{fmt.rule}\n{fmt.window_label}"),
                bound_text("window_end"),
                F.lit("\n"),
                F.concat_ws("\n", F.col("lines.line")),
                F.lit("\n"),
            ).alias("report"),
        )
    )
