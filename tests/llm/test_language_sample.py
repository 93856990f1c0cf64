"""What the language operator brings to the driver."""

from pyspark.sql import functions as F

from profile_lake.llm import language


def test_sample_is_full_and_bounded_where_one_id_has_many_rows(spark, monkeypatch):
    langs = [f"l{k}" for k in range(6)]
    rows = [(k, f"text {i} of {lang}", lang) for k, lang in enumerate(langs) for i in range(300)]
    rows += [(100, "the same", "l0")] * 200 + [(101, "1 2 3", "l1")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    brought, collect = [], type(docs).collect

    def counted(self):
        out = collect(self)
        brought.append(len(out))
        return out

    monkeypatch.setattr(type(docs), "collect", counted)
    settings = language.Settings(per_language=20)
    sample = language.labelled_sample(docs, F.lit(True), settings)
    assert [sum(lang == x for _, lang in sample) for x in langs] == [20] * 6
    assert len(set(sample)) == len(sample) and max(brought) <= 20 * 6
    assert all(any(c.isalpha() for c in text) for text, _ in sample)
    assert language.labelled_sample(docs.repartition(7), F.lit(True), settings) == sample
