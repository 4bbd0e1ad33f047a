"""Literal cases of the text, box and key functions."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.functions import boxes as B
from lamina.functions import keys as K
from lamina.functions import text as T
from lamina.operators import headings as H
from lamina.operators import merge as M


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values()) or (0,)], ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in values.items()) or "x int")
    return frame.select(column.alias("v")).first().v


def test_tile_key_is_the_digest_of_parts(spark):
    wanted = hashlib.sha256(b"abc" + b"\0" + "提示".encode() + b"\0" + b"m").hexdigest()
    assert one(spark, K.tile_key(F.col("a"), F.lit("提示"), F.lit("m")), a="abc") == wanted


def test_config_digest_ignores_order():
    assert K.config_digest({"b": 1, "a": 2}) == K.config_digest({"a": 2, "b": 1}) != K.config_digest({"a": 3, "b": 1})
    assert K.config_digest({"a": 1, "x": 2}, without=("x",)) == K.config_digest({"a": 1})


@pytest.mark.parametrize(
    "text,inner",
    [("```markdown\n# A\n```", "# A"), ("```md\nx\n```", "x"), ("```\nx\n```", "x"), ("a\n```\nb\n```", "a\n```\nb\n```"), ("  y \n", "y"), ("```python\nx\n```", "python\nx")],
)
def test_fence(spark, text, inner):
    assert one(spark, T.strip_fence(F.col("t")), t=text) == inner


@pytest.mark.parametrize("html,empty", [("<table><tr><td>", True), ("```html\n<table><tr><td", True), ("<table><tr><td></td></tr></table>", False), ("<table><tr><td>1", False)])
def test_truncated_empty(spark, html, empty):
    assert one(spark, T.is_truncated_empty(F.col("t")), t=html) is empty


def test_line_join_puts_a_space_between_ascii_only(spark):
    assert one(spark, T.join_line(F.array(F.lit("abc"), F.lit(" 12"), F.lit("中"), F.lit(""), F.lit("x")))) == "abc 12中x"


def test_names_read_in_the_wrong_encoding(spark):
    official = "表格图片.png"
    broken = official.encode("utf-8").decode("gb18030", errors="strict")
    assert spark.createDataFrame([(broken,), ("plain.png",)], "n string").select(T.repair_name("n").alias("n")).collect() == [(official,), ("plain.png",)]


def reply(content, nested=True):
    inner = {"choices": [{"message": {"content": content}}]}
    return json.dumps({"success": True, "result": {"result": json.dumps(inner) if nested else inner}}, ensure_ascii=False)


@pytest.mark.parametrize(
    "payload,content,error",
    [
        (reply("```markdown\n# 标题\n\n正文\n```"), "# 标题\n\n正文", None),
        (reply([{"text": "a"}, {"text": "b"}], nested=False), "ab", None),
        (reply(""), None, "empty"),
        (reply("服务器繁忙，请稍后重试"), None, "temporary"),
        ('{"success": false, "message": "无权限"}', None, "permanent"),
        ('{"success": false, "message": "请求过载"}', None, "temporary"),
        ('{"success": false, "message": "content is empty"}', None, "empty"),
        ('{"success": true}', None, "permanent"),
        ('{"success": true, "result": {"result": "{}"}}', None, "permanent"),
    ],
)
def test_responses(spark, payload, content, error):
    told = one(spark, T.response_content(F.col("p")), p=payload)
    assert (told.content, told.error) == (content, error)


def test_prompt_echo(spark):
    assert one(spark, T.strip_prompt_echo(F.col("t")), t="Please strictly follow these guidelines.\n# A") == "# A"
    assert one(spark, T.strip_prompt_echo(F.col("t")), t="Output only the converted text") == ""


def test_users_rotate(spark):
    users = F.array(F.lit("a"), F.lit("b"), F.lit("a"), F.lit("c"))
    assert one(spark, K.rotated(users, F.lit("b"))) == ["b", "c", "a"]


def test_blank_images(spark):
    blank = lambda *v: one(spark, B.is_blank(*map(F.lit, v)))
    assert blank(0, 0, 262144, 255, 255) and blank(262144, 0, 262144, 244, 244) and not blank(350, 0, 262144, 240, 255)


def test_split_trigger(spark):
    split = lambda w, h: one(spark, B.needs_split(F.lit(w), F.lit(h), F.lit(300_000), F.lit(3000), F.lit(512)))
    assert split(1088, 3900) and not split(1088, 1800)


HINTS = "array<struct<heading_id:string,level:int>>"


def repaired(spark, f, text, hints=None, kind=HINTS, last=None):
    frame = spark.createDataFrame([(text, hints, last)], f"t string, h {kind}, r {'boolean' if isinstance(last, bool) else 'string'}")
    return frame.select(f(F.col("t"), F.col("h"), F.col("r")).alias("v")).first().v


def test_restore_levels_and_budget(spark):
    restore = lambda *a: repaired(spark, H.restore, *a)
    hints = [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    text = "保险条款\n正文内容，很长。\n## 1 总则\n1.1 范围\n1.1.1 定义\n1）枚举"
    assert restore(text, hints) == "# 保险条款\n正文内容，很长。\n## 1 总则\n### 1.1 范围\n#### 1.1.1 定义\n1）枚举"
    assert repaired(spark, H.restore, "目录\n1 总则", [("a", 1)], HINTS, "table_of_contents") == "# 目录\n1 总则"
    assert restore("# A\n# B\n# C", [("a", 1), ("b", 2), ("a", 3), ("c", 3)]) == "# A\n## B\n### C"  # an id counts once
    assert restore("1 甲\n2 乙\n3 丙", [("a", 2), ("b", 2)]) == "## 1 甲\n## 2 乙\n3 丙"  # no more than hinted
    assert restore("# x", None) == "# x" and restore(None, hints) is None and restore("", hints) == ""


def test_align_and_definitions(spark):
    align = lambda text, levels: repaired(spark, lambda t, h, r: H.align(t, h), text, levels, "array<int>")
    promote = lambda text, known=False: repaired(spark, lambda t, h, r: H.promote_definitions(t, r), text, None, HINTS, known)
    assert align("### a\n#### b\n#### c", [2, 3]) == "## a\n### b\n### c"
    assert align("### a\n#### b", [2, 3]) == "## a\n### b" and align("# a\n###### b\nx", [3]) == "### a\n###### b\nx"
    assert align("**x**\n正文\n**y**", [2, 3]) == "## x\n正文\n### y" and align("**x**", [2, 3]) == "**x**"
    assert align("# 长标题\n# 的\n# 后半\n\n# 另一", [1, 1, 1, 1]) == "# 长标题 的 后半\n\n# 另一" and align("x", None) == "x"
    three = "**1. 甲：**\n**2. 乙：**\n**3. 丙：**"
    assert promote(three) == "#### 1. 甲：\n#### 2. 乙：\n#### 3. 丙：" and promote(three, True) == three
    assert promote("**1. 甲：**\n**2. 乙：**") == "**1. 甲：**\n**2. 乙：**" and promote("**1. 甲：**\n**9. 乙：**\n**5. 丙：**\n**2. 丁：**") == "**1. 甲：**\n**9. 乙：**\n**5. 丙：**\n**2. 丁：**"
    renumber = lambda t: repaired(spark, lambda t, h, r: H.renumber(t), t)
    assert renumber("### 1 总则\n# 1.1 范围\n## 1.1.1 定义\n1 正文") == "## 1 总则\n### 1.1 范围\n#### 1.1.1 定义\n1 正文"


def test_context_is_removed_once(spark):
    strip = lambda text, context, already: repaired(spark, H.strip_context, text, context, "array<string>", already)
    assert strip("# 甲\n\n## 乙\n正文\n## 乙", ["甲", "乙"], True) == "正文\n## 乙"
    assert strip("## 乙\n正文", ["甲", "乙"], True) == "正文" and strip("# 甲\n## 丙\n正文", ["甲", "乙", "丙"], True) == "正文"
    assert strip("## 丙\n正文", ["甲", "乙", "丙"], True) == "## 丙\n正文"  # two are missing
    assert strip("# 甲\n正文", ["甲"], False) == "# 甲\n正文" and strip("正文", [], True) == "正文"


def test_overlaps_join_once():
    shared = "0123456789" * 3
    assert M.seam_of("left " + shared, shared + " right") == f"left {shared} right"
    assert M.seam_of("a\nb c", "b  c\nd") == "a\nb c\nd"
    assert M.seam_of("a", "b") == "a\nb" and M.seam_of("", "b") == "b"


@settings(max_examples=200, deadline=None)
@given(st.text("ab\n ", max_size=70), st.text("ab\n ", max_size=70), st.booleans())
def test_seams_equal_brute_force(left, right, overlapping):
    right = left[-25:] + right if overlapping else right
    a, b = left.rstrip(), right.lstrip()
    n = max((k for k in range(20, min(len(a), len(b)) + 1) if a[-k:] == b[:k]), default=0)
    if not a or not b:
        wanted = a or b
    elif n:
        wanted = a + b[n:]
    else:
        bare, x, y = (lambda rows: ["".join(r.split()) for r in rows]), a.splitlines(), b.splitlines()
        m = max((k for k in range(1, min(len(x), len(y), 20) + 1) if bare(x[-k:]) == bare(y[:k])), default=0)
        wanted = "\n".join(x + y[m:]).strip() if m else f"{a}\n{b}"
    assert M.seam_of(left, right) == wanted


def test_parts_keep_the_first_header(spark):
    shared = "0123456789" * 3
    rows = [(1, 0, "# 目录\n第一部分", 0), (1, 1, "# 目录\n\n第二部分", 0), (2, 0, "x", 0), (3, 0, f"# A\n## B\nend {shared}", 0), (3, 1, f"# A\n\n## B!\n{shared} more\n# A", 5), (4, 0, "", 0), (4, 1, "# T\ny", 0), (4, 2, None, 0)]
    parts = spark.createDataFrame(rows, "k int, n int, markdown string, overlap_top int")
    got = {r.k: r.markdown for r in M.merged(parts, "k", ["n"], headings=2).collect()}
    assert got == {1: "# 目录\n第一部分\n\n第二部分", 2: "x", 3: f"# A\n## B\nend {shared} more\n# A", 4: "# T\ny"}
    assert M.merged(parts.limit(0), "k", ["n"]).count() == 0


def test_pack_repair(spark):
    repair = lambda *a: repaired(spark, H.repair_pack, *a)
    assert repair("# 8 释义\n正文", [("a", 2)]) == "## 8 释义\n正文"
    assert repair("# 一、概述\n正文", [("a", 3)]) == "### 一、概述\n正文"
    assert repair("保险条款\n正文。", [("a", 1)]) == "# 保险条款\n正文。"
    assert repaired(spark, H.repair_pack, "目录\n1 总则", [("a", 1)], HINTS, "table_of_contents") == "# 目录\n1 总则"


def test_stripping_equals_python_and_numbers_are_matched_once(spark):
    """Each pattern stands in an expression once, so a line is matched once."""
    blanks = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    texts = ["", *blanks, "".join(blanks), *(f"{b}a{b}b{b}" for b in blanks), "\u200ba\u200b", "  😀\n\n"]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert [r[0] for r in frame.select(T.strip(F.col("t"))).collect()] == [*map(str.strip, texts), None]
    told = frame.select(H.renumber(F.col("t")).alias("x"))._jdf.queryExecution().optimizedPlan().expressions().toString()
    assert [told.count(p) for p in (r"^(\d+(?:", *(p for p, _ in T.NUMBERED))] == [1] * 5
