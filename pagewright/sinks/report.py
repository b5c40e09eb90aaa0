"""HTML reports. Only aggregates and the detail rows of one page or partition at a time come to the driver.

A single page names the rows that it doesn't show; ``check_pages`` and ``comparison_pages`` give all of them.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.operators import stats

_PAGE = "<!DOCTYPE html><html><head><meta charset='utf-8'><title>{title}</title></head><body><h1>{title}</h1>{body}</body></html>"


def _cards(values: dict[str, object]) -> str:
    return "<div>" + "".join(f"<section><h2>{html.escape(k)}</h2><p>{html.escape(str(v))}</p></section>" for k, v in values.items()) + "</div>"


def _paged(rows: DataFrame, limit: int) -> Iterator[list]:
    """All rows in order, ``limit`` at a time; one empty page where there are none."""
    it = rows.toLocalIterator()
    page = list(islice(it, limit))
    yield page
    while page := list(islice(it, limit)):
        yield page


def _rest(shown: int, total: int) -> str:
    return f"<p>{total - shown} more not shown</p>" if total > shown else ""


def _details(results: DataFrame, key: str, errors: str) -> DataFrame:
    number = F.coalesce(F.col(key).cast("string").try_cast("int"), F.lit(0))
    return results.select(F.col(key).alias("k"), number.alias("n"), F.posexplode(errors).alias("i", "e")).orderBy("n", "k", "i")


def _check_page(total, rows: list, start: int = 1, rest: str = "") -> str:
    items = "".join(f"<li><b>{html.escape(str(r.k))}</b> {html.escape(r.e['content'] or '')} → {html.escape(r.e['rightSentences'] or '')}</li>" for r in rows)
    opening = "<ol>" if start == 1 else f"<ol start='{start}'>"
    return _PAGE.format(title="Check report", body=_cards({"errors": total.n_errors, "characters": total.n_chars}) + f"{opening}{items}</ol>{rest}")


def check_html(results: DataFrame, key: str = "id", errors: str = "errors", limit: int = 10_000) -> str:
    """Summary cards and the first errors in order of their record's number."""
    total, details = stats.check_report(results, key, errors).first(), _details(results, key, errors)
    rows = details.limit(limit).collect()
    return _check_page(total, rows, rest=_rest(len(rows), details.count()) if len(rows) == limit else "")


def check_pages(results: DataFrame, key: str = "id", errors: str = "errors", limit: int = 10_000) -> Iterator[str]:
    """All errors, ``limit`` a page, each page with the summary cards."""
    total = stats.check_report(results, key, errors).first()
    for i, rows in enumerate(_paged(_details(results, key, errors), limit)):
        yield _check_page(total, rows, i * limit + 1)


def _comparison_page(rows: list, model: str, rest: str = "") -> str:
    table = "".join(f"<tr><td>{html.escape(str(r[model]))}</td><td>{r['match']}</td><td>{r.mismatch}</td><td>{r.total}</td><td>{r.rate:.1f} %</td></tr>" for r in rows)
    return _PAGE.format(title="Model comparison", body=f"<table><tr><th>model</th><th>match</th><th>mismatch</th><th>total</th><th>rate</th></tr>{table}</table>{rest}")


def comparison_html(pairs: DataFrame, model: str, base: str, other: str, limit: int = 1000) -> str:
    """Agreement of each model with the rules, the best first."""
    rates = stats.match_rates(pairs, model, base, other).orderBy(F.desc("rate"), model)
    rows = rates.limit(limit).collect()
    return _comparison_page(rows, model, _rest(len(rows), rates.count()) if len(rows) == limit else "")


def comparison_pages(pairs: DataFrame, model: str, base: str, other: str, limit: int = 1000) -> Iterator[str]:
    """All models, ``limit`` a page."""
    for rows in _paged(stats.match_rates(pairs, model, base, other).orderBy(F.desc("rate"), model), limit):
        yield _comparison_page(rows, model)


def highlight(text, query: str):
    """A column with the query marked, whatever its case."""
    import re

    return F.regexp_replace(text, f"(?i)({re.escape(query)})", "<mark>$1</mark>")


