"""Each registered layout query against its SQL, and the driver's contract."""

import pytest

import __spark_entry__ as entry
from compare import same
from lamina.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    same(QUERIES[name](spark, sf), sf, ORACLES[name])


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_suppression_keeps_one_of_each_pair(spark, sf):
    from lamina.operators import dedup
    from lamina.plans.catalogue import _boxes

    boxes = _boxes(spark, sf).cache()
    kept = dedup.suppress(boxes, ["l_orderkey", "label"], 0.3)
    assert dedup.dominated_pairs(kept.where("y2 > y1"), ["l_orderkey", "label"], 0.3, 200).count() == 0
    assert 0 < kept.count() < boxes.count()
    boxes.unpersist()


def test_joined_slices_equal_brute_force(spark, sf):
    """All seams of each document, folded in plain Python."""
    import hashlib

    def whole(text):
        parts = [text[a : a + 1500] for a in range(0, max(0, len(text) - 201) + 1, 1300)]
        out = parts[0].strip()
        for part in parts[1:]:
            a, b = out.rstrip(), part.strip()
            n = max((k for k in range(20, min(len(a), len(b), 1600) + 1) if a.endswith(b[:k])), default=0)
            assert n or not a or not b
            out = a + b[n:] if a and b else a or b
        return out.strip()

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: r.merged_hash for r in QUERIES["q_overlap_merge"](spark, sf).collect()}
    assert found == {i: hashlib.sha256(whole(t).encode()).hexdigest() for i, t in texts.items()}


def test_slices_are_cut_and_merged_in_one_pass(spark, tmp_path):
    """Odd texts keep their row, and one Python step merges."""
    import hashlib

    unit = "".join(f"{i} 😀 " for i in range(700))
    texts = {0: "", 1: None, 2: " \n", 3: "# A\n\n" + "# A\nline\n" * 400, 4: unit[:1501], 5: unit, 6: unit[:201], 7: "y" * 200}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    df = QUERIES["q_overlap_merge"](spark, str(tmp_path))
    found = {r.doc_id: r.merged_hash for r in df.collect()}
    assert set(found) == set(texts)
    for i in (0, 1, 2, 4, 5, 6, 7):
        assert found[i] == hashlib.sha256((texts[i] or "").strip().encode()).hexdigest()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Window" not in plan


def same_on_rows(spark, folder, name, table, rows, schema):
    """A query against its SQL on one table of the given rows."""
    import duckdb

    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    theirs = connection.sql(ORACLES[name])
    ours = QUERIES[name](spark, str(folder)).select(*theirs.columns).collect()
    assert sorted(map(repr, map(tuple, ours))) == sorted(map(repr, theirs.fetchall()))


ODD_TEXTS = ["", None, " ", "\n", " \n ", "\t", "\ta\t", "\u3000a\u00a0", "a\r\n", "```", "```\na\n```", "```md\na", "a\n```", "|", "| a |", "a\n\nb", "a\n\n\n", "\n\nlong line that is no gap\n\nx\n" + "y" * 90, "x\n" + "y" * 200 + "\n\n\n" + "z" * 200 + "\n"]


def test_fence_strip_of_odd_texts(spark, tmp_path):
    rows = [(2 * i + k, t) for i, t in enumerate(ODD_TEXTS) for k in (0, 1)]
    same_on_rows(spark, tmp_path, "q_fence_strip", "documents", rows, "doc_id long, text string")


def test_heading_lines_of_odd_pages(spark, tmp_path):
    inside = ["", " ", "a ", " a", "\ta\t", "a\u00a0", "#", "# a", "a\nb", "a\rb", "a\u2028b", "a\u0085", "|", "<b>a</b>", "a</h1> <h1>b"]
    pages = [None, "", "<p>none</p>", "<H1>a</H1>", "<h1>open"] + [f"<h1 class='x'>{x}</h1>" for x in inside]
    same_on_rows(spark, tmp_path, "q_heading_lines", "pages", [(f"u{i}", x) for i, x in enumerate(pages)], "url string, html string")


def test_shallow_merge_of_odd_texts(spark, tmp_path):
    same_on_rows(spark, tmp_path, "q_shallow_merge", "documents", list(enumerate(ODD_TEXTS)), "doc_id long, text string")
