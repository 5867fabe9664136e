from __future__ import annotations

from collections import defaultdict

from cases import collected, documents
from pyspark.sql import functions as F

from roadstream.llm import lines
from roadstream.llm.common import ROW


def brute_force(rows, least):
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            sites[line].add(source)
    spread = {line for line, s in sites.items() if len(s) >= least and line.strip(" ")}
    out = []
    for doc_id, text, _ in rows:
        held = [] if text is None else text.split("\n")
        kept = [line for line in held if line not in spread]
        if not any(line.strip(" ") for line in kept):
            kept = held
        out.append(
            (doc_id, len(held), len(held) - len(kept), None if text is None else "\n".join(kept))
        )
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    sources = [None, *[f"s{i}" for i in range(30)]]
    rows = [(None, "menu\nmine", "s1"), (500, "menu\n \nmenu", "s2"), (501, None, "s3")]
    rows += [(502, "", None), (503, "\n", "s1"), (504, "menu", "s9"), (505, "menu", "s9")]
    for n, source in enumerate(sources):
        text = "menu\nown %d\n\nmenu" % n
        for least, line in ((8, "eight"), (9, "nine"), (10, "ten"), (11, "eleven"), (12, "twelve")):
            text += f"\n{line}" if n < least else ""
        rows.append((n, text, source))
        rows.append((n, text, source))
    made = lines.without_spread_lines(documents(spark, rows)).select(
        f"{ROW}.doc_id", "n_lines", "n_removed", "clean_text"
    )
    found = collected(made, "doc_id", "n_lines", "n_removed", "clean_text")
    assert found == brute_force(rows, lines.MIN_SITES)


def test_line_on_every_document_and_long_texts(spark):
    rows = [(i % 90, f"license\nown {i}", f"s{i % 40}") for i in range(300)]
    rows += [(None, "license\nsame", "s1")] * 60
    rows += [(1000, "license\n" + "long " * 60_000 + "\n" + "x\n" * 20_000, "s2")]
    made = lines.without_spread_lines(documents(spark, rows)).select(
        f"{ROW}.doc_id", "n_lines", "n_removed", "clean_text"
    )
    found = collected(made, "doc_id", "n_lines", "n_removed", "clean_text")
    assert found == brute_force(rows, lines.MIN_SITES)


def test_occurrences_of_a_common_line_go_to_many_places(spark):
    spread = spark.createDataFrame([(1, 3000), (2, 1), (3, 10)], "line long, n long")
    placed, slot = lines._slots(spread, 64)
    assert placed.groupBy("line").count().rdd.collectAsMap() == {1: 64, 2: 1, 3: 64}
    seen = spark.range(3000).select(F.lit(1).alias("line"), F.col("id").alias("key"))
    most = seen.select(slot.alias("slot")).groupBy("slot").count().agg(F.max("count")).first()[0]
    assert most <= 2 * 3000 / 64


def test_the_text_is_dealt_out_once(spark):
    rows = [(i, f"menu\nown {i}", f"s{i}") for i in range(20)]
    made = lines.without_spread_lines(documents(spark, rows))
    node = made._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().head()
    dealt = node.children().head().output()
    assert [dealt.apply(i).name() for i in range(dealt.size())] == [ROW, "key"]


def test_empty_table(spark):
    assert lines.without_spread_lines(documents(spark, [])).count() == 0
