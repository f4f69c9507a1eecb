"""HTML table fragments, one page of rows at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.operators.numbering import number_rows

# The columns a digest shows, with their headings.
DIGEST_COLUMNS = {
    "title": "Title",
    "assignee": "Assignee",
    "missing_labels": "Missing Label",
    "missing_dates": "Missing Date",
    "missing_effort": "Missing Effort Spent",
    "missing_root_cause": "Missing Root Cause",
    "missing_comments": "Missing Comments",
}
# End of fixed values.


def escaped(text: Column) -> Column:
    """Text safe inside HTML; null becomes empty."""
    safe = F.coalesce(text.cast("string"), F.lit(""))
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        safe = F.replace(safe, F.lit(raw), F.lit(entity))
    return safe


def cell_flags(metrics: tuple[str, ...], flagged: tuple[str, ...]) -> dict[str, Column]:
    """One boolean per metric: its cell calls for action. Metrics outside
    ``flagged`` never do."""
    return {
        f"flag_{m}": (F.coalesce(F.col(m) != "No", F.lit(True)) if m in flagged else F.lit(False))
        for m in metrics
    }


def row_html(flagged: tuple[str, ...], link: str) -> Column:
    """One table row; the title links to the issue, flagged cells are marked."""
    cells: list[Column] = [F.lit("<tr>")]
    for name in DIGEST_COLUMNS:
        if name in flagged:
            mark = F.when(F.coalesce(F.col(name) != "No", F.lit(True)), '<td class="gap">').otherwise("<td>")
        else:
            mark = F.lit("<td>")
        body = escaped(F.col(name))
        if name == "title":
            body = F.concat(F.lit('<a href="'), escaped(F.col(link)), F.lit('">'), body, F.lit("</a>"))
        cells += [mark, body, F.lit("</td>")]
    return F.concat(*cells, F.lit("</tr>"))


def digest_pages(
    rows: DataFrame,
    recipient: str,
    order_by: list[Column],
    flagged: tuple[str, ...],
    page_rows: int,
    link: str = "issueurl",
) -> DataFrame:
    """(recipient, page, row_count, html): every row, in order, ``page_rows`` to a
    page, so that no fragment grows with the data. Rows without a recipient get pages
    of their own, with a null recipient."""
    header = "<tr>" + "".join(f"<th>{h}</th>" for h in DIGEST_COLUMNS.values()) + "</tr>"
    numbered = number_rows(rows, order_by, "_number", [recipient])
    page = (F.floor((F.col("_number") - 1) / page_rows) + 1).cast("bigint").alias("page")
    # Sorting (number, fragment) pairs keeps the order inside a page.
    body = F.array_sort(F.collect_list(F.struct("_number", "_row")))
    return (
        numbered.select(F.col(recipient), page, "_number", row_html(flagged, link).alias("_row"))
        .groupBy(recipient, "page")
        .agg(F.count(F.lit(1)).alias("row_count"), F.array_join(body["_row"], "").alias("_body"))
        .select(
            recipient, "page", "row_count",
            F.concat(F.lit(f"<table>{header}"), F.col("_body"), F.lit("</table>")).alias("html"),
        )
    )
