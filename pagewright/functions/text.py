"""Text functions as Column expressions: everything here stays inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Blank characters as Unicode has them, sentence marks, closing signs, kinds of label, patterns of titles.
BLANK = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TERMINAL = "。！？!?…:：；;"
CLOSERS = "”’\"'》>】]"
TITLE = r"^第[\p{Nd}一二三四五六七八九十百]+[章节篇]"
TITLE_FORMS = (
    r"^第[一二三四五六七八九十百千万\p{Nd}]+[章节篇部分条款]",
    r"^[一二三四五六七八九十]+[、，\.]",
    r"^\([一二三四五六七八九十]+\)",
    r"^（[一二三四五六七八九十]+）",
    r"^\p{Nd}+\.",
    r"^\(\p{Nd}+\)",
    r"^（\p{Nd}+）",
)
CIRCLED = "".join(chr(c) for c in range(0x2460, 0x2474))
#: Control characters that a broken text layer leaves.
CONTROLS = "".join(chr(c) for c in (*range(1, 9), 11, *range(14, 32), 127))
# Fixed value: the listed set, which also deletes printed characters.
GARBLED = "\x03Җ&˅ᮠᦞҹAṸᇎ+᡻޼\x12\x11\x0f\x15\x13\x19\x17\x103\x1a\x1b\x18\x14ĉ'ѝᇦ(ᵜṨᆇ"


def strip(text: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def last_char(text: Column) -> Column:
    """The last character that counts: one closing sign at the end is passed over. '' for blank texts."""
    t = F.coalesce(strip(text), F.lit(""))
    last = F.right(t, F.lit(1))
    return F.when((F.length(t) > 1) & F.lit(CLOSERS).contains(last), F.substring(t, -2, 1)).otherwise(last)


def is_terminal(char: Column) -> Column:
    return (F.length(char) > 0) & F.lit(TERMINAL).contains(char)


def cut_off(text: Column) -> Column:
    """Whether a paragraph stops before its end: it has a last character, and that is no sentence mark."""
    c = last_char(text)
    return (c != "") & ~is_terminal(c)


def is_title(line: Column) -> Column:
    return strip(line).startswith("#") | line.rlike(TITLE)


def is_title_format(text: Column) -> Column:
    t = strip(text)
    return t.startswith("#") | t.rlike("|".join(TITLE_FORMS))


def ends_sentence(line: Column) -> Column:
    return strip(line).rlike(r"[。！？!?]$")


def _lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def first_line(text: Column) -> Column:
    return F.get(_lines(text), F.lit(0))


def last_line(text: Column) -> Column:
    lines = _lines(text)
    return F.when(F.size(lines) > 0, F.element_at(lines, -1))


def may_join(last: Column, first: Column, least: int = 6) -> Column:
    """Whether the text whose last line is ``last`` goes on in one whose first line is ``first`` (null: there is none)."""
    return F.coalesce(last.isNotNull() & first.isNotNull() & ~is_title(first) & ~ends_sentence(last) & (F.length(last) > least), F.lit(False))


def label_prefix(label: Column, text: Column) -> Column:
    """Markdown heading signs by label; '' for blank texts."""
    t = F.coalesce(text, F.lit(""))
    return F.when(strip(t) == "", "").when(label == "title", F.concat(F.lit("# "), t)).when(label == "sub_title", F.concat(F.lit("## "), t)).otherwise(t)


def staged_prefix(label: Column, text: Column) -> Column:
    """The staged pipeline's signs: a line break before titles, sub-titles and images, '#' before titles."""
    sign = F.when(label == "title", "\r\n#").when(label == "sub_title", "\r\n##").when(label == "image", "\r\n").otherwise("")
    return F.when(F.coalesce(text, F.lit("")) == "", F.coalesce(text, F.lit(""))).otherwise(F.concat(sign, text))


def footnote_letters(text: Column) -> Column:
    """Letters a to t, of either case, as circled numbers."""
    low = "abcdefghijklmnopqrst"
    return F.translate(text, low + low.upper(), CIRCLED + CIRCLED)


def special_spaces(text: Column) -> Column:
    return F.translate(text, " \x07\x01", "   ")


def clean_characters(text: Column, listed: bool = False) -> Column:
    """Without control characters; ``listed`` deletes the full list, printed characters included, and turns # into breaks."""
    if not listed:
        return F.translate(text, CONTROLS, "")
    return F.replace(F.replace(F.translate(text, GARBLED, ""), F.lit("##"), F.lit("\n")), F.lit("#"), F.lit("\n"))


def strip_references(text: Column) -> Column:
    """Without note marks and commas or colons at the end."""
    t = strip(F.regexp_replace(strip(text), r"[①-⑳]+$", ""))
    t = strip(F.regexp_replace(t, r"(?:\[\p{Nd}+\]|（\p{Nd}+）|\(\p{Nd}+\))+$", ""))
    return strip(F.regexp_replace(t, r"[，,;；:：]+$", ""))


# What a chapter heading begins with behind the page number of a line of contents.
CHAPTER = r"第[一二三四五六七八九十百千万]+[章节篇部分条款]"


def contents_breaks(text: Column, glued: bool = False) -> Column:
    """A line break behind the page number of each line of a table of contents, once.

    ``glued`` also breaks between a number and a heading sign or chapter, parted by blanks or by nothing.
    """
    out = F.regexp_replace(text, r"([.。…]{2,}[\s\x{3000}]*\p{Nd}++)(?![\n\r])", "$1\n")
    if glued:
        out = F.regexp_replace(out, rf"(\p{{Nd}})(?:{BLANK}+(?=[第#])|(?={CHAPTER}|[第#]))", "$1\n")
    return F.replace(out, F.lit("\n\n"), F.lit("\n"))


def no_punctuation(text: Column, keep_blanks: bool = True) -> Column:
    kept = r"[^\p{L}\p{N}_\s]" if keep_blanks else r"[^\p{L}\p{N}_]"
    return F.regexp_replace(text, kept, "")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), r"[ \t\n\r\f]+", " ")


def shorten(text: Column, n: int = 100) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def mask_name(name: Column, head: int = 6, tail: int = 24) -> Column:
    """Names over 26 characters with stars for their middle."""
    return F.when(F.length(name) > 26, F.concat(F.left(name, F.lit(head)), F.repeat(F.lit("*"), F.length(name) - 26), F.right(name, F.lit(tail)))).otherwise(name)


def json_object(text: Column) -> Column:
    """From the first opening to the last closing brace; null without both."""
    start, back = F.instr(text, "{"), F.instr(F.reverse(text), "}")
    end = F.length(text) - back + 1
    return F.when((start > 0) & (back > 0) & (end > start), F.substring(text, start, end - start + 1))


def unfence(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def markdown_table(rows: Column) -> Column:
    """Cells (array of arrays of strings, the header first) as a Markdown table; '' without rows."""
    cell = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" "))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(F.transform(cells, cell), " | "), F.lit(" |\n"))
    header = F.get(rows, F.lit(0))
    rule = F.concat(F.lit("| "), F.array_join(F.transform(header, lambda _: F.lit("---")), " | "), F.lit(" |\n"))
    body = F.array_join(F.transform(F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0))), line), "")
    return F.when(F.size(rows) < 1, "").otherwise(F.concat(line(header), rule, body))


def visible_length(text: Column) -> Column:
    """Characters without # and blanks."""
    return F.length(F.translate(text, "# \n\r\t　", ""))


def sanitize_model(name: Column) -> Column:
    return F.translate(name, ".:-", "___")


#: Seconds that a token is good for.
TOKEN_LIFE = 3 * 24 * 3600


def encrypt_token(text: Column, key: Column) -> Column:
    """AES-GCM as url-safe base64 (nonce, cipher, tag)."""
    return F.translate(F.base64(F.aes_encrypt(text, key, F.lit("GCM"))), "+/", "-_")


def decrypt_token(token: Column, key: Column) -> Column:
    """The text of a token, null for foreign or broken ones."""
    return F.try_aes_decrypt(F.unbase64(F.translate(token, "-_", "+/")), key, F.lit("GCM")).cast("string")


def expiring_token(text: Column, key: Column, now: Column | None = None, life: int = TOKEN_LIFE) -> Column:
    """A token of the text and the second at which it expires."""
    until = F.unix_timestamp(now if now is not None else F.current_timestamp()) + life
    return encrypt_token(F.to_json(F.struct(text.alias("t"), until.alias("exp"))), key)


def valid_token(token: Column, key: Column, now: Column | None = None) -> Column:
    """The text of a token that hasn't expired, else null."""
    held = F.from_json(decrypt_token(token, key), "t string, exp bigint")
    return F.when(held["exp"] > F.unix_timestamp(now if now is not None else F.current_timestamp()), held["t"])
