"""Markup residue: clean text that keeps headings, lists, tables, code and formulas recognisable.

A text is fed through the standard library's HTML parser, whose events give the tags (what the parser takes for a tag counts
by its name or by the full syntax of one), and through tokenisers for the Markdown, wiki and LaTeX signs in the data between
them. The events give each line its text-to-tag ratio: the characters of text, but for those inside links, menus and forms,
over the number of events. A text has markup if the ratio of any line counts an event. The ratios are smoothed with a Gaussian,
and a two-cluster threshold separates the content regions; lines outside them go from the clean text if their ratio is zero,
that is if they hold nothing but tags, links and menus. Headings, items, cells, code and formulas are content wherever they
stand. What stays is written in one plain notation: ``# `` headings, ``- `` items, ``| a | b |`` rows, fenced code, ``$ $``
formulas.

Signs of the printed text (comparisons, prices, paths, note marks, page numbers) are no events. Time and memory are linear in
the text, but for pathological runs of opening signs.
"""

from __future__ import annotations

import bisect
import html
import math
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.tables import map_arrow, once_by_hash

#: Element names (HTML and those of wikis) that count as tags whatever follows them, and LaTeX commands that
#: count wherever they stand. Other names need the full syntax of a tag, other commands a place where no path can be.
ELEMENTS = set(
    "a abbr address article aside b blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main map mark math meta nav nobr noscript object ol option p param picture pre q rp rt ruby s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr ref references nowiki gallery syntaxhighlight blink big".split()
)
COMMANDS = "alpha approx begin beta bf bibitem bigskip cdot cdots centering chapter cite citep citet cos delta ell emph end epsilon eqref equiv eta exists footnote footnotesize forall frac ge geq gamma hline hspace href huge in include includegraphics infty input int iota it item kappa label lambda large ldots le left leftarrow leftrightarrow leq lim ln log mathbb mathbf mathcal mathrm medskip mu nabla ne neq newline newpage noindent omega par paragraph partial phi pi prime prod psi qquad quad ref right rightarrow rho rm sc section sigma sim sin small smallskip sqrt sub subsection subsubsection sum tan tau textbf textit textrm textsc textsf textsuperscript texttt theta times title tt underline url usepackage vspace xi zeta".split()
_CMD = "|".join(sorted(COMMANDS, key=len, reverse=True))
_ARG = "textbf|textit|textsc|texttt|emph|section|subsection|subsubsection|chapter|paragraph|cite|citep|citet|footnote|caption|label|eqref|ref|begin|end|frac|sqrt|item|url|href"
_NAMES = "|".join(sorted(ELEMENTS, key=len, reverse=True))

#: Signs of the printed text that look like markup: drive and UNC paths.
_PRINTED = regex.compile(r"(?<![A-Za-z])[A-Za-z]:\\[^\s，。；）)]*|\\\\[\w.-]+\\[^\s]*")

#: Event patterns, in order of precedence: kind, what it is, pattern. Those from the HTML parser come first of all.
PATTERNS: list[tuple[str, str, regex.Pattern]] = [
    (k, w, regex.compile(p, regex.M))
    for k, w, p in (
        ("markdown", "fence", r"^\s*(?:`{3,}|~{3,})\s*[\w+-]*\s*$"),
        ("markdown", "fence", r"`{3,}"),
        ("latex", "formula", r"\\\((?:(?!\\\)).)*\\\)|\\\[(?:(?!\\\]).)*\\\]|\$\$[^$]+\$\$"),
        ("latex", "formula", r"(?<![\w\\$])\$(?=[^\s$])[^$\n]*?(?:\\[A-Za-z]|[\^_{}])[^$\n]*?\$(?!\d)"),
        ("latex", "delimiter", r"\\[()\[\]](?![\w])"),
        ("latex", "environment", r"\\(?:begin|end)\s*(?:\{[^{}\n]*\}?)?(?:\[[^\]\n]*\])?"),
        ("latex", "command", rf"~?\\(?:{_CMD})(?![A-Za-z])\*?(?:\[[^\]\n]*\])?"),
        ("latex", "command", r"~?\\[A-Za-z]{2,}\*?(?=\{)"),
        # not inside a path, nor at the head of one
        ("latex", "command", r"(?<![A-Za-z0-9._\-]{2}|[\\:/.])~?\\[A-Za-z]{2,}(?![A-Za-z0-9\\/.\-]*[\\/]|[A-Za-z0-9_\-]|\.[A-Za-z0-9])\*?"),
        ("latex", "command", rf"(?<![A-Za-z\\])(?:{_ARG})(?=\{{[^{{}}\n]+\}})"),
        ("latex", "break", r"\\\\(?=\s*$|\s*\[|\s+\S)|\s&\s(?=[^\n]*\\\\)"),
        ("wiki", "heading", r"^\s*={2,6}\s*[^=\n]+?\s*={2,6}\s*$|^\s*={2,6}\s+[^=\n]+$|^[^=\n]+\s={2,6}\s*$"),
        ("wiki", "emphasis", r"'{2,5}"),
        ("wiki", "link", r"\[\[|\]\]"),
        ("wiki", "link", r"\[https?://[^\s\]]+\s[^\]\n]*\]"),
        ("wiki", "template", r"\{\{\{?[^{}\n]{0,200}\|?|\}\}\}?"),
        ("wiki", "table", r"^\s*\{\|[^\n]*$|^\s*\|\}|^\s*\|[-+][^\n|]*$|\|\}\s*$|(?<=\S)\s*(?:\|\||!!)\s*(?=\S)"),
        ("wiki", "magic", r"__(?:TOC|NOTOC|FORCETOC|NOEDITSECTION)__|^#(?:REDIRECT|重定向)\b"),
        ("markdown", "image", r"!\[[^\]\n]*\]?(?:\([^)\n]*\)?)?"),
        ("markdown", "link", r"(?<!\])\[[^\]\[\n]+\]\([^)\s]+(?:\s+\"[^\"\n]*\")?\)|\]\((?:[#/.\w][^)\s]*[./#:][^)\s]*|#[^)\s]+)\)?|\[[^\]\[\n]+\]\((?=\S*[/#.])[^)\s]*$"),
        ("markdown", "link", r"^\s*\[[^\]\n]+\]:\s+\S+"),
        ("markdown", "heading", r"^\s{0,3}#{1,6}[ \t]+(?=\S)"),
        ("markdown", "heading", r"^\s*(?:={3,}|-{3,})\s*$"),
        ("markdown", "table", r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?\s*$|^\s*\|?(?::?-{3,}:?\|)+\s*$"),
        ("markdown", "table", r"^\s*\|(?=[^\n|]*\S[^\n|]*\|)|(?<=\S)\s*\|\s*$"),
        ("markdown", "quote", r"^\s*(?:>\s?)+(?=\s*\S)"),
        ("markdown", "list", r"^\s*[-+*]\s+(?:\[[ xX]\]\s+)?(?=[^\s\d*+-]|\d[^\n]{6,})"),
        ("markdown", "emphasis", r"(?<![\d*])\*{2,3}(?![\d*])|(?<![\w*])__(?=[^\s_])|(?<=[^\s_])__(?![\w_])"),
        ("markdown", "emphasis", r"(?<![A-Za-z0-9*\\])\*(?=[^\s*\d])[^*\n]*?(?<=[^\s*])\*(?![A-Za-z0-9*])"),
        ("markdown", "emphasis", r"(?<![A-Za-z0-9_\\/])_(?=[^\s_])[^_\n]*?(?<=[^\s_])_(?![A-Za-z0-9_/]|\.[A-Za-z0-9])"),
        ("markdown", "strike", r"~~"),
        ("markdown", "code", r"(?<!`)`[^`\n]+`(?!`)|`(?=\S)"),
        ("html", "remnant", rf"</?(?:{_NAMES})(?:\s+[\w:-]+(?:\s*=\s*(?:\"[^\"<>]*\"?|'[^'<>]*'?|[^\s<>\"']*))?)*\s*/?$"),
        ("html", "remnant", r"^[^<>]{0,200}?(?:\b(?:class|style|id|href|src|colspan|rowspan|width|align|name)\s*=\s*\"[^\"<>]*\"\s*)+/?>"),
        ("html", "remnant", rf"^(?:/?(?:{_NAMES}))\s*/?>"),
        ("html", "remnant", r"<!--|-->|<!\[CDATA\[|\]\]>|<!DOCTYPE\b"),
    )
]
_ENTITY = regex.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_PAGE_LINE = regex.compile(r"^\s*[-–—*·]\s*[\divxlcIVXLC]{1,6}\s*[-–—*·]\s*$", regex.M)
_STARS = regex.compile(r"^\s*\*(?:\s*\*)+\s*$", regex.M)
#: Names of elements of no list: an optional prefix, at least two characters.
_NAME = regex.compile(r"(?:[a-z][\w.-]*:)?[a-z](?:[\w-]|\.(?!\d))+", regex.A | regex.I)
_BARE_END = regex.compile(r"</[A-Za-z][\w.:-]*\s*>", regex.A)
#: Elements whose text leads elsewhere, and those that make a line content whatever its ratio.
ASIDE = set("a nav menu button option select form aside script style".split())
CONTENT = set("h1 h2 h3 h4 h5 h6 li dd dt td th tr caption pre code sub sup math".split())

#: A cheap test, for the JVM: a text without any of these signs has no event.
SIGNS = r"[<>`\\{}\[|$&#*_~=]|''|(?m)^\s*[-+]\s|-{3,}"


@dataclass(frozen=True)
class Event:
    kind: str
    what: str
    start: int
    end: int


def _is_tag(name: str, attrs: list[tuple[str, str | None]] | None) -> bool:
    """Whether what the parser calls a tag is one: by a known name, or by its syntax (attributes have values)."""
    return name in ELEMENTS or bool(_NAME.fullmatch(name)) and all(v is not None and regex.fullmatch(r"[\w:.-]+", k) for k, v in attrs or ())


class _Tags(HTMLParser):
    """Spans of the tags, comments and declarations of a text, and of what stands inside elements that lead elsewhere."""

    def __init__(self, text: str) -> None:
        super().__init__(convert_charrefs=False)
        self.text, self.spans, self.aside, self.content, self.stack = text, [], [], [], []
        self.lines = [0] + [m.end() for m in regex.finditer("\n", text)]
        self.feed(text)
        self.close()

    def at(self) -> int:
        line, offset = self.getpos()
        return self.lines[line - 1] + offset

    def take(self, end: int, name: str = "") -> None:
        at = self.at()
        if end > at:
            self.spans.append((at, end))
            if name in CONTENT:
                self.content.append(at)

    def handle_starttag(self, tag: str, attrs) -> None:
        raw = self.get_starttag_text() or ""
        if _is_tag(tag, attrs) and "<" not in raw[1:]:
            self.take(self.at() + len(raw), tag)
            if tag in ASIDE:
                self.stack.append((tag, self.at() + len(raw)))

    def handle_startendtag(self, tag: str, attrs) -> None:
        raw = self.get_starttag_text() or ""
        if _is_tag(tag, attrs) and "<" not in raw[1:]:
            self.take(self.at() + len(raw))

    def handle_endtag(self, tag: str) -> None:
        at = self.at()
        end = self.text.find(">", at) + 1
        if end and (tag in ELEMENTS or _BARE_END.fullmatch(self.text, at, end) and _is_tag(tag, None)):
            self.take(end, tag)
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == tag:
                    self.aside.append((self.stack[k][1], at))
                    del self.stack[k:]
                    break

    def handle_comment(self, data: str) -> None:
        at = self.at()
        if self.text.startswith("<!--", at) and self.text.startswith("-->", at + 4 + len(data)):
            self.take(at + 7 + len(data))

    def handle_decl(self, decl: str) -> None:
        at = self.at()
        if decl.upper().startswith("DOCTYPE") and self.text.startswith(">", at + 2 + len(decl)):
            self.take(at + 3 + len(decl))


class _Free:
    """Which places of a text no event has taken."""

    def __init__(self, n: int) -> None:
        self.mask = bytearray(n)

    def take(self, a: int, b: int) -> bool:
        """Takes the span if it is free."""
        if self.mask.find(1, a, b) >= 0:
            return False
        self.mask[a:b] = b"\x01" * (b - a)
        return True


@dataclass
class Parsed:
    """The events of a text, in order of place, the spans that lead elsewhere and the places of content elements."""

    events: list[Event]
    aside: list[tuple[int, int]]
    content: list[int]


def parse(text: str) -> Parsed:
    free, found = _Free(len(text)), []
    for pattern, sign in ((_PRINTED, "\\"), (_PAGE_LINE, ""), (_STARS, "*")):
        if sign in text:
            for m in pattern.finditer(text):
                free.mask[m.start() : m.end()] = b"\x01" * (m.end() - m.start())
    tags = _Tags(text) if "<" in text else None
    if tags:
        found += [Event("html", "tag", *span) for span in tags.spans if free.take(*span)]
    if "&" in text:
        found += [Event("html", "entity", *m.span()) for m in _ENTITY.finditer(text) if html.unescape(m.group()) != m.group() and free.take(*m.span())]
    for kind, what, pattern in PATTERNS:
        found += [Event(kind, what, *m.span()) for m in pattern.finditer(text) if m.end() > m.start() and free.take(*m.span())]
    found = sorted(_plausible(found, text), key=lambda e: e.start)
    return Parsed(found, tags.aside if tags else [], tags.content if tags else [])


def _plausible(found: list[Event], text: str) -> list[Event]:
    """Takes single weak signs out: a lone bar, one list mark, one closing pair."""
    weak = {("markdown", "table"), ("wiki", "table")}
    strong = [e for e in found if (e.kind, e.what) not in weak]
    bars = [e for e in found if (e.kind, e.what) in weak]
    if not strong and bars:
        firm = any(e.kind == "wiki" or "-" in text[e.start : e.end] or text[e.start : e.end].lstrip().startswith("|") for e in bars)
        return bars if firm else []
    return found


def markup(text: str) -> list[Event]:
    """The markup events of a text, none for printed signs."""
    return parse(text).events


class _Writer(HTMLParser):
    """HTML events to plain notation."""

    BLOCKS = {"p", "div", "section", "article", "table", "ul", "ol", "dl", "blockquote", "figure", "header", "footer", "tr", "center"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skip = 0
        self.cells = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in ELEMENTS:
            self.other(tag, attrs)
        elif tag in ("script", "style"):
            self.skip += 1
        elif len(tag) == 2 and tag[0] == "h" and tag[1].isdigit():
            self.out.append("\n" + "#" * int(tag[1]) + " ")
        elif tag in ("li", "dd", "dt"):
            self.out.append("\n- ")
        elif tag == "br":
            self.out.append("\n")
        elif tag == "hr":
            self.out.append("\n---\n")
        elif tag == "tr":
            self.out.append("\n|")
            self.cells = 0
        elif tag in ("td", "th"):
            self.out.append(" ")
        elif tag == "pre":
            self.out.append("\n```\n")
        elif tag == "code":
            self.out.append("`")
        elif tag == "sup":
            self.out.append("^")
        elif tag in ("sub", "ref"):
            self.out.append("_" if tag == "sub" else " (")
        elif tag in self.BLOCKS:
            self.out.append("\n")

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in ("br", "hr"):
            self.handle_starttag(tag, attrs)
        elif tag not in ELEMENTS:
            self.other(tag, attrs)

    def other(self, tag: str, attrs) -> None:
        """What is no tag by its syntax is printed text."""
        raw = self.get_starttag_text() or ""
        if not _is_tag(tag, attrs):
            self.out.append(raw)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("td", "th"):
            self.out.append(" |")
        elif tag == "pre":
            self.out.append("\n```\n")
        elif tag == "code":
            self.out.append("`")
        elif tag == "ref":
            self.out.append(")")
        elif len(tag) == 2 and tag[0] == "h" and tag[1].isdigit() or tag in self.BLOCKS or tag == "li":
            self.out.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.out.append(data)


#: Rewriting of the other notations into the plain one, in order: (pattern, replacement).
_REWRITE: list[tuple[regex.Pattern, object]] = [
    (regex.compile(p, regex.M | f), r)
    for p, f, r in (
        (r"\\\((.*?)\\\)", regex.S, r"$\1$"),
        (r"\\\[(.*?)\\\]", regex.S, r"$$\1$$"),
        (r"\\(?:begin|end)\{(?:equation|align|displaymath|math)\*?\}", 0, "$$"),
        (r"\\(?:begin|end)\{(?:verbatim|lstlisting)\}", 0, "```"),
        (r"\\(?:begin|end)\{[^{}\n]*\}(?:\[[^\]\n]*\])?", 0, ""),
        (r"\\chapter\*?\{([^{}\n]*)\}", 0, r"# \1"),
        (r"\\section\*?\{([^{}\n]*)\}", 0, r"## \1"),
        (r"\\(?:sub)+section\*?\{([^{}\n]*)\}", 0, r"### \1"),
        (r"^\s*\\item(?:\[[^\]\n]*\])?\s*", 0, "- "),
        (r"~?\\(?:cite[pt]?|ref|eqref|label)\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}", 0, ""),
        (r"\\(?:textbf|textit|textsc|texttt|textrm|emph|underline|text|title|footnote)\*?\{([^{}\n]*)\}", 0, r"\1"),
        (r"^\s*={2}\s*([^=\n]+?)\s*={2}\s*$", 0, r"## \1"),
        (r"^\s*={3}\s*([^=\n]+?)\s*={3}\s*$", 0, r"### \1"),
        (r"^\s*={4,6}\s*([^=\n]+?)\s*={4,6}\s*$", 0, r"#### \1"),
        (r"'{2,5}", 0, ""),
        (r"\[\[(?:File|Image|文件|图像):[^\[\]]*\]\]", 0, ""),
        (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", 0, r"\1"),
        (r"\[\[([^\[\]]*)\]\]", 0, r"\1"),
        (r"\{\{[^{}|]*\|(?:[^{}|=]*=)?([^{}|]*)[^{}]*\}\}", 0, r"\1"),
        (r"\{\{[^{}]*\}\}", 0, ""),
        (r"^\s*\{\|[^\n]*$|^\s*\|\}|\|\}\s*$|^\s*\|-[^\n]*$", 0, ""),
        (r"^\s*[|!]\s*([^\n|][^\n]*?(?:\|\||!!)[^\n]*)$", 0, lambda m: "| " + regex.sub(r"\s*(?:\|\||!!)\s*", " | ", m.group(1)) + " |"),
        (r"!\[([^\]\n]*)\]\([^)\n]*\)", 0, r"\1"),
        (r"(?<!\!)\[([^\]\[\n]+)\]\([^)\s]+(?:\s+\"[^\"\n]*\")?\)", 0, r"\1"),
        (r"\*{2,3}([^*\n]+?)\*{2,3}", 0, r"\1"),
        (r"(?<![A-Za-z0-9*\\])\*(?=[^\s*\d])([^*\n]*?)(?<=[^\s*])\*(?![A-Za-z0-9*])", 0, r"\1"),
        (r"(?<![A-Za-z0-9_\\/])_{1,2}(?=[^\s_])([^_\n]*?)(?<=[^\s_])_{1,2}(?![A-Za-z0-9_/]|\.[A-Za-z0-9])", 0, r"\1"),
        (r"~~([^~\n]*)~~", 0, r"\1"),
        (r"^\s*(?:>\s?)+", 0, ""),
        (r"^\s*[*+]\s+(?=\S)", 0, "- "),
        (r"\s*\\\\\s*$", 0, ""),
        (r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?\s*$", 0, ""),
    )
]
_WORD = regex.compile(r"[\p{L}\p{N}]")
_FENCED = regex.compile(r"(```.*?```|`[^`\n]+`|\$\$.*?\$\$|\$[^$\n]+\$)", regex.S)


@dataclass
class Line:
    """A line: its span, its events and characters of text, those of them inside elements that lead elsewhere."""

    start: int
    end: int
    n_events: int = 0
    n_text: int = 0
    n_aside: int = 0
    content: bool = False

    @property
    def ratio(self) -> float:
        return max(0, self.n_text - self.n_aside) / max(1, self.n_events)


#: Events that make a line content whatever its ratio.
_KEPT = {("markdown", "fence"), ("markdown", "heading"), ("markdown", "list"), ("markdown", "table"), ("markdown", "code"), ("wiki", "heading"), ("wiki", "table"), ("latex", "formula"), ("latex", "environment"), ("latex", "delimiter"), ("latex", "command")}
_PRINTS = regex.compile(r"\S")


def measured(text: str, parsed: Parsed) -> list[Line]:
    """The lines of a text with what their ratios are made of."""
    lines, a = [], 0
    for part in text.split("\n"):
        lines.append(Line(a, a + len(part)))
        a += len(part) + 1
    starts = [x.start for x in lines]
    prints = bytearray(len(text))
    for m in _PRINTS.finditer(text):
        prints[m.start()] = 1
    for e in parsed.events:
        prints[e.start : e.end] = bytes(e.end - e.start)
        for k in range(bisect.bisect_right(starts, e.start) - 1, bisect.bisect_left(starts, e.end)):
            lines[k].n_events += 1
            lines[k].content |= (e.kind, e.what) in _KEPT
    for at in parsed.content:
        lines[bisect.bisect_right(starts, at) - 1].content = True
    for x in lines:
        x.n_text = prints.count(1, x.start, x.end)
    for a, b in parsed.aside:
        for k in range(bisect.bisect_right(starts, a) - 1, bisect.bisect_left(starts, b)):
            lines[k].n_aside += prints.count(1, max(a, lines[k].start), min(b, lines[k].end))
            prints[max(a, lines[k].start) : min(b, lines[k].end)] = bytes(max(0, min(b, lines[k].end) - max(a, lines[k].start)))
    return lines


def outside(lines: list[Line]) -> list[bool]:
    """Which lines are outside the content regions: in the lower cluster of the smoothed ratios, with a ratio of zero by their
    tags, links and menus, and no content by their kind. None where the ratios don't differ."""
    own = [x.ratio for x in lines]
    level = smooth(own)
    border = threshold(level)
    return [border > 0 and s <= border and x.ratio == 0 and x.n_events > 0 and not x.content for s, x in zip(level, lines)]


def smooth(values: list[float], sigma: float = 1.0) -> list[float]:
    reach = math.ceil(2 * sigma)
    weights = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        part = [(values[j], weights[j - i + reach]) for j in range(max(0, i - reach), min(len(values), i + reach + 1))]
        out.append(sum(v * w for v, w in part) / sum(w for _, w in part))
    return out


def threshold(values: list[float]) -> float:
    """The border between two clusters (one-dimensional 2-means); 0 where the values don't differ."""
    lo, hi = min(values), max(values)
    if hi - lo < 1e-9:
        return 0.0
    for _ in range(20):
        cut = (lo + hi) / 2
        low, high = [v for v in values if v <= cut], [v for v in values if v > cut]
        lo, hi, before = sum(low) / len(low), sum(high) / len(high), (lo, hi)
        if before == (lo, hi):
            break
    return (lo + hi) / 2


def clean(text: str, parsed: Parsed | None = None) -> str:
    """The text without markup. A text without events comes back as it is."""
    parsed = parse(text) if parsed is None else parsed
    found = parsed.events
    if not found:
        return text
    lines = measured(text, parsed)
    if any(out := outside(lines)):
        # tags of the dropped lines stay, as elements may begin or end there
        text = "\n".join("".join(t for e in found if e.what == "tag" and x.start <= e.start < x.end for t in (text[e.start : e.end],)) if drop else text[x.start : x.end] for x, drop in zip(lines, out))
    if any(e.kind == "html" for e in found):
        if any(e.what == "entity" for e in found) and regex.search(rf"&lt;/?(?:{_NAMES})\b", text):
            text = html.unescape(text)
        writer = _Writer()
        writer.feed(text)
        writer.close()
        text = "".join(writer.out)
    parts = _FENCED.split(text)
    for i in range(0, len(parts), 2):
        for pattern, to in _REWRITE:
            parts[i] = pattern.sub(to, parts[i])
    text = "".join(parts)
    text = regex.sub(r"[ \t]+\n", "\n", text)
    return regex.sub(r"\n{3,}", "\n\n", text).strip("\n")


def may_have(text: str | Column) -> Column:
    return F.col(text).rlike(SIGNS) if isinstance(text, str) else text.rlike(SIGNS)


def marked(df: DataFrame, key: str, text: str) -> DataFrame:
    """Texts with markup: key, kinds (sorted, joined by commas), n_events, n_lines, n_outside (lines outside the content regions).

    A text is found if the text-to-tag ratio of one of its lines counts an event. Null, empty and unmarked texts give no row.
    Texts without any sign never leave the JVM. A row delivered twice counts once; other columns are ignored.
    """
    source = df.filter(F.col(text).isNotNull()).filter(may_have(text)).select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = df.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for i, t in enumerate(batch.column(1).to_pylist()):
            parsed = parse(t)
            lines = measured(t, parsed) if parsed.events else []
            if any(x.n_events for x in lines):
                rows.append((i, ",".join(sorted({e.kind for e in parsed.events})), len(parsed.events), len(lines), sum(outside(lines))))
        if not rows:
            return None
        c = list(zip(*rows))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(c[0])), pa.array(c[1]), *[pa.array(x, pa.int64()) for x in c[2:]]], names=["k", "kinds", "n_events", "n_lines", "n_outside"])

    return map_arrow(source, run, f"k {kind}, kinds string, n_events bigint, n_lines bigint, n_outside bigint").distinct().withColumnRenamed("k", key)


def cleaned(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every text: key, kinds ('' without markup), clean. Null texts stay null; unmarked texts stay as they are.

    A key and text delivered twice give one row; texts of keys that occur once aren't moved.
    """
    once = once_by_hash(df.select(F.col(key).alias("k"), F.col(text).alias("t")), "k", "t")
    kind = df.schema[key].dataType.simpleString()
    signs = F.coalesce(may_have("t"), F.lit(False))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in batch.column(1).to_pylist():
            parsed = parse(t)
            rows.append((",".join(sorted({e.kind for e in parsed.events})), clean(t, parsed)))
        c = list(zip(*rows))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(c[0]), pa.array(c[1], pa.string())], names=["k", "kinds", "clean"])

    plain = once.filter(~signs).select("k", F.lit("").alias("kinds"), F.col("t").alias("clean"))
    return map_arrow(once.filter(signs), run, f"k {kind}, kinds string, clean string").unionByName(plain).withColumnRenamed("k", key)
