"""The main text of a web page by text density, with the standard library's parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_SKIPPED = {"script", "style", "noscript", "nav", "footer", "aside", "form", "head", "template", "svg", "button"}
_BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "article", "section", "blockquote", "pre", "br", "main", "ul", "ol", "table", "tr"}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.skip: list[str] = []
        self.blocks: list[tuple[str, int]] = [("", 0)]
        self.link = 0

    def _cut(self) -> None:
        if self.blocks[-1][0].strip():
            self.blocks.append(("", 0))

    def handle_starttag(self, tag: str, attrs) -> None:
        if self.skip or tag in _SKIPPED:
            if tag in _SKIPPED:
                self.skip.append(tag)
            return
        self.link += tag == "a"
        if tag in _BLOCKS:
            self._cut()

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            if tag in self.skip:
                del self.skip[len(self.skip) - 1 - self.skip[::-1].index(tag) :]
            return
        self.link = max(0, self.link - (tag == "a"))
        if tag in _BLOCKS:
            self._cut()

    def handle_data(self, data: str) -> None:
        if not self.skip:
            text, linked = self.blocks[-1]
            self.blocks[-1] = (text + data, linked + (len(data) if self.link else 0))


def main_text(source: str | None, link_share: float = 0.5) -> str | None:
    """The page's blocks that aren't mostly links, one to a line; None if there is none or the page can't be read."""
    try:
        reader = _Reader()
        reader.feed(source or "")
        reader.close()
    except Exception:  # noqa: BLE001  a page that the parser can't read is dropped
        return None
    kept = [" ".join(t.split()) for t, linked in reader.blocks if t.strip() and linked <= link_share * len(t)]
    return "\n".join(kept) or None


@F.pandas_udf(StringType())
def _main_text(s: pd.Series) -> pd.Series:
    return s.map(main_text)


def extracted(html: Column) -> Column:
    return _main_text(html)
