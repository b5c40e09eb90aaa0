"""HTML fragments: closing what is left open, over Arrow batches with the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Open(HTMLParser):
    """Elements that are open at the end, in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.stack: list[str] = []

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in self.stack:
            while self.stack.pop() != tag:
                pass


def close_open_tags(text: str | None) -> str | None:
    """The fragment with end tags for its open elements, innermost first; null stays null."""
    if not text or "<" not in text:
        return text
    parser = _Open()
    parser.feed(text)
    return text + "".join(f"</{t}>" for t in reversed(parser.stack))


def closed(text: Column) -> Column:
    """struct<text, changed>."""

    @F.pandas_udf("struct<text:string,changed:boolean>")
    def run(s: pd.Series) -> pd.DataFrame:
        out = [close_open_tags(x) for x in s]
        return pd.DataFrame({"text": out, "changed": [a != b for a, b in zip(out, s)]})

    return run(text)
