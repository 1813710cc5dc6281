"""Quotation linking against its SQL and on planted quotes."""

import random

import duckdb

from corpusmill.llm import quotes

DDL = "conv_id long, turn long, role string, text string"


def thread(conv):
    return [
        (conv, 0, "user", "How do I bake bread?\nI have flour."),
        (conv, 1, "assistant", "Use yeast and water.\n\nKnead well."),
        (conv, 2, "user", "Nice weather today."),
        (conv, 3, "user", "> Use  YEAST and water.\n>\n> Knead well.\nHow much yeast?"),
        (conv, 4, "assistant", "> > Use yeast and water.\n> How much yeast?\nTen grams."),
        (conv, 5, "user", "> nobody said this\nOdd."),
        (conv, 6, "user", ">>> \n> Nice weather today.\nIndeed."),
    ]


def test_planted_quotes(spark):
    got = {r.turn: r for r in quotes.reply_order(spark.createDataFrame(thread(1), DDL)).collect()}
    assert [got[t].reply_to for t in range(7)] == [None, 0, 1, 1, 3, 4, 2]
    assert [got[t].by_quote for t in range(7)] == [False, False, False, True, True, False, True]
    assert got[3].text == "How much yeast?" and got[5].text == "Odd." and got[4].n_linked == 2
    assert [got[t].branch for t in range(7)] == [None, None, None, 3, 4, 4, 6]
    assert [got[t].depth for t in range(7)] == [0, 0, 0, 1, 2, 2, 1]
    order = sorted(got, key=lambda t: got[t].place)
    assert order == [0, 1, 2, 3, 6, 4, 5]
    assert all(order.index(got[t].reply_to) < order.index(t) for t in got if got[t].reply_to is not None)


def test_query_equals_sql(spark, tmp_path):
    rnd = random.Random(2)
    words = "red green blue, Gold. grey".split()
    rows = []
    for conv in range(25):
        said = []
        for turn in range(rnd.randrange(1, 12)):
            lines = [" ".join(rnd.choices(words, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(0, 3))]
            if said and rnd.random() < 0.6:
                old = rnd.choice(said).split("\n")
                lines = ["> " * rnd.randrange(1, 3) + x.upper() for x in old[: rnd.randrange(1, 4)]] + lines
            text = "\n".join(lines)
            said.append(text)
            rows.append((conv, turn, "user", text or None))
    spark.createDataFrame(rows + thread(99), DDL).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cursor = con.execute(quotes.SQL)
    names = [d[0] for d in cursor.description]
    want = sorted(map(str, cursor.fetchall()))
    got = quotes.query(spark, str(tmp_path))
    assert sorted(got.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in got.select(*names).collect()) == want


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a"), (None, 1, None, "> a\nb"), (1, None, "user", "> x"), (1, 0, "user", None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 3, "user", "w " * 50_000)]
    df = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS place", "2 AS branch")  # clashing names
    got = quotes.reply_order(df).collect()
    assert len(got) == len(rows)
    assert [(r.reply_to, r.by_quote) for r in got if r.conv is None and r.turn == 1] == [(0, True)]
    assert sorted(r.place for r in got if r.conv == 1) == [1, 2, 3, 4, 5]
    assert all(r.reply_to is None for r in got if r.turn in (0, None))
    assert quotes.reply_order(df.limit(0)).count() == 0


def test_long_conversations_are_cut_into_parts(spark):
    rows = [(1, t, "user", f"message {t}") for t in range(2500)]
    ordered = quotes.reply_order(spark.createDataFrame(rows, DDL))
    parts = {r.part: [m.turn for m in r.messages] for r in quotes.conversations(ordered).collect()}
    assert parts[0] + parts[1] + parts[2] == list(range(2500))
