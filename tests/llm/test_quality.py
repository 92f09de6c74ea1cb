"""Quality rules against their SQL, with texts that have no words."""

import duckdb

from scrutin.llm import quality
from scrutin.llm.queries import QUALITY_SQL, quality_rules


def test_texts_without_words_fail_and_end_nothing(spark, folder):
    plain = " ".join(f"the w{i} of" for i in range(40))
    texts = [None, "", " ", " \t\n\x0b\r\n ", "\n\n", "###", plain, plain + "\n" + plain, "a " * 60, "#" * 9 + " " + plain]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    docs.write.parquet(f"{folder}/documents.parquet")
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    got = quality_rules(spark, folder)
    db = duckdb.connect()
    db.sql(f"create view documents as from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = db.sql(QUALITY_SQL)
    assert got.columns == want.columns
    found = {r.doc_id: tuple(r) for r in got.collect()}
    assert found == {r[0]: r for r in want.fetchall()}
    assert [found[i][-1] for i in range(6)] == [False] * 6 and found[6][-1]
    whole = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    assert all(whole[i].failed_rules == [r.name for r in quality.RULES] for i in range(5))
