import sentencepiece
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as c
from flowgauge.llm import personal_data, toxicity
from flowgauge.llm.tables import kept, table
from tests.llm.test_near_joins import expected


def test_against_plain_python(spark, sf):
    docs = table(spark, sf, "documents")
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    model = toxicity.fitted(docs, table(spark, sf, "labels"))
    rows = {i: t for i, t in rows.items() if toxicity.scored([t], model, {})[0][0] < 0.7}
    groups = expected(rows.items())
    rows = {i: t for i, t in rows.items() if groups[i][0] == i}
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    rows = {i: t for i, t in rows.items() if not any(x in t for x in items)}
    left = docs.where(F.col("doc_id").isin(list(rows)))
    tagger = personal_data.fitted(left)
    order = list(rows)
    found = personal_data.found_in([rows[i] for i in order], tagger)
    rows = {i: personal_data.redacted(rows[i], base + added) for i, (base, added) in zip(order, found)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: (r.text, r.ids) for r in c.run(spark, sf).collect()}
    assert got == {i: (t, library.encode(t)) for i, t in rows.items()}


def test_messy_rows(spark, messy, no_rows, sf):
    docs = messy.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                        F.char_length("text").cast("long").alias("n_chars"), "score", "row", "held_out", "n_links")
    for start in (docs, no_rows.select(*[F.lit(None).cast(t).alias(n) for n, t in docs.dtypes])):
        now = start
        for name, stage in c.STAGES[:-1]:
            now = kept(stage(spark, now, sf), name)
            assert now.columns == docs.columns
        rows = c.STAGES[-1][1](spark, now, sf).collect()
        assert (len(rows) > 0) == (start is docs)
        if rows:
            assert [r.text for r in rows if r.doc_id == 14] == ["Contact [EMAIL] or [PHONE] now."]
