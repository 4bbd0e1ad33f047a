"""Text functions on Markdown, HTML and service messages; all run on the JVM unless they say otherwise."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: Parts of messages of a service that is busy.
BUSY = ["识别失败", "请求过载", "请求超载", "服务器繁忙", "系统繁忙", "服务繁忙", "模型繁忙", "稍后重试", "too many requests", "overload", "temporarily unavailable"]
#: Protocols that take no prompt.
WITHOUT_PROMPT = ["official_multipart", "local_paddleocr_vl", "local_firered_ocr"]
#: The white space that trimming removes.
BLANKS = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Chinese numerals of numbered headings, and the patterns of those that aren't Arabic with their levels.
_NUMERAL = "一二三四五六七八九十百"
NUMBERED = [(f"^第[{_NUMERAL}0-9]+章", 2), (f"^第[{_NUMERAL}0-9]+[节条]", 3), (f"^[{_NUMERAL}]+[、．.]", 2), (f"^[（(][{_NUMERAL}0-9]+[）)]", 4)]
#: What a heading's signature leaves out besides white space, and the ends of a sentence.
PUNCTUATION = r"#：:，,。．.、（）()\-—_"
SENTENCE_ENDS = "。；;，,"


def with_one(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it: a one-element array carries it."""
    return F.transform(F.array(value), f)[0]


def strip(text: Column) -> Column:
    """Trims white space, ideographic spaces included."""
    return F.btrim(text, F.lit(BLANKS))


def lines(text: Column) -> Column:
    return F.split(text, r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{0085}\x{2028}\x{2029}]")


def strip_fence(text: Column) -> Column:
    """The inside of a text that is one fenced block with no info string, ``markdown`` or ``md``; else the trimmed text."""
    whole, fenced = strip(text), r"(?is)\A```(?:markdown|md)?\s*\n?(.*?)\n?```\z"
    return F.when(whole.rlike(fenced), strip(F.regexp_extract(whole, fenced, 1))).otherwise(whole)


def is_busy(message: Column) -> Column:
    return F.lower(strip(message)).rlike("|".join(BUSY))


def prompt_for(protocol: Column, prompt: Column) -> Column:
    return F.when(protocol.isin(*WITHOUT_PROMPT), F.lit("")).otherwise(prompt)


def numbered_level(text: Column) -> Column:
    """Heading level of a numbered line, null if it isn't one."""
    arabic = r"^(\d+(?:\.\d+){0,4})(?:[\s\x{3000}、．]|$)"

    def told(value: Column, number: Column) -> Column:
        dots = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit("")))
        out = F.when((number != "") & ((dots > 0) | (F.length(F.regexp_replace(number, "^0+", "")) <= 2)), F.least(F.lit(5), dots + 2)).when(number != "", F.lit(None).cast("int"))
        for pattern, level in NUMBERED:
            out = out.when(value.rlike(pattern), F.lit(level))
        return out

    return with_one(strip(text), lambda value: with_one(F.regexp_extract(value, arabic, 1), lambda number: told(value, number)))


def heading_marks(line: Column) -> Column:
    """Number of heading marks of a Markdown line, 0 if it is no heading."""
    return F.length(F.regexp_extract(line, r"^(#{1,6})\s+\S", 1))


def heading_text(line: Column) -> Column:
    return F.regexp_extract(line, r"(?d)^#{1,6}\s+(.+?)\s*$", 1)


def signature(text: Column) -> Column:
    """A heading without white space and punctuation, lower-cased."""
    return F.lower(F.regexp_replace(text, rf"[\s\x{{3000}}{PUNCTUATION}]", ""))


def preview(text: Column, most: int = 240) -> Column:
    return F.substring(F.regexp_replace(text, r"\s+", " "), 1, most)


def html_escape(text: Column) -> Column:
    out = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def visible_html(html: Column) -> Column:
    """Text outside tags; an unclosed tag at the end doesn't show, nor does an opening fence."""
    return strip(F.regexp_replace(F.regexp_replace(strip(html), r"\A```[A-Za-z]*", ""), r"<[^>]*(>|\z)", ""))


def is_truncated_empty(html: Column) -> Column:
    """Unclosed table HTML that shows nothing."""
    return (visible_html(html) == "") & html.rlike("(?i)<t") & ~strip(html).rlike(r"(?i)</table>\s*(```)?\z")


def strip_prompt_echo(text: Column) -> Column:
    """Without a task preamble that the backend has copied to the start; may leave nothing."""
    return strip(F.regexp_replace(text, r"(?is)\A\s*(?:you are an? [^\n]*\n|please (?:strictly )?follow [^\n]*(?:\n|\z)|(?:task|instructions?)\s*:[^\n]*(?:\n|\z)|output only [^\n]*(?:\n|\z)|convert (?:the|this) [^\n]*(?:\n|\z))+", ""))


def join_line(texts: Column) -> Column:
    """Texts of one line, in order: a space only between two ASCII letters or digits."""
    parts = F.filter(F.transform(texts, strip), lambda t: t != "")
    return F.aggregate(parts, F.lit(""), lambda acc, t: F.when(acc.rlike("[A-Za-z0-9]$") & t.rlike("^[A-Za-z0-9]"), F.concat(acc, F.lit(" "), t)).otherwise(F.concat(acc, t)))


def part_name(index: Column, column: Column, x: Column) -> Column:
    return F.format_string("part_%03d_c%02d_x%05d.png", index.cast("int"), column.cast("int"), x.cast("int"))


_OUTER = "struct<success:string,message:string,result:struct<result:string>>"
_INNER = "struct<choices:array<struct<message:struct<content:string>>>>"


def response_content(payload: Column) -> Column:
    """A struct (content, error) of a service's nested response.

    ``error`` is ``permanent``, ``temporary``, ``empty`` or null.  The inner result may be a JSON string; the content
    may be a string or a list of texts.  Each level is parsed once.
    """

    def told(outer: Column) -> Column:
        content = F.from_json(outer["result"]["result"], _INNER)["choices"][0]["message"]["content"]
        return with_one(content, lambda c: with_one(stripped(c), lambda text: judged(outer, c, text)))

    def stripped(content: Column) -> Column:
        listed = F.array_join(F.transform(F.from_json(content, "array<struct<text:string>>"), lambda x: F.coalesce(x["text"], F.lit(""))), "")
        return strip_fence(F.when(content.rlike(r"^\s*\[\s*\{"), F.coalesce(listed, content)).otherwise(content))

    def judged(outer: Column, content: Column, text: Column) -> Column:
        message = F.coalesce(outer["message"], F.lit("success=false"))
        failed = F.coalesce(outer["success"], F.lit("")) != "true"
        error = (
            F.when(failed & F.lower(message).contains("content is empty"), "empty")
            .when(failed & is_busy(message), "temporary")
            .when(failed | content.isNull(), "permanent")
            .when(text == "", "empty")
            .when((F.length(text) <= 240) & is_busy(text), "temporary")
        )
        return F.struct(F.when(error.isNull(), text).alias("content"), error.alias("error"))

    return with_one(F.from_json(payload, _OUTER), told)


@F.pandas_udf(StringType())
def repair_name(names: pd.Series) -> pd.Series:
    """Names whose UTF-8 bytes were read as GB18030; others stay.  The codec isn't among Spark's."""

    def repaired(name):
        try:
            return name.encode("gb18030").decode("utf-8")
        except (UnicodeError, AttributeError):
            return name

    return names.map(repaired)


@F.pandas_udf(DoubleType())
def heading_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Share of matching characters of two headings' signatures, as the standard library's matcher has it."""
    import re
    from difflib import SequenceMatcher

    plain = lambda s: re.sub(rf"[\s{PUNCTUATION}]", "", s or "").lower()
    return pd.Series([SequenceMatcher(None, plain(a), plain(b)).ratio() for a, b in zip(left, right, strict=True)], dtype="float64")
