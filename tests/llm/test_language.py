import zlib

from pyspark.sql import functions as F

from ledgerspark.llm import language
from ledgerspark.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_language_id"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(both) == len(docs)
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out, strict=True))
    both = both[both.held_out]
    assert (both.lang == both.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_odd_rows_and_no_labels(spark, odd_docs, no_docs):
    model = language.train(odd_docs)
    p = odd_docs.select("doc_id", language.language(model, F.col("text")).alias("p")).select("doc_id", "p.*").collect()
    by = {r.doc_id: r for r in p}
    assert len(p) == odd_docs.count()
    assert all((by[k].lang, by[k].score) == ("und", 0.0) for k in (1, 2, 3))
    assert by[7].lang == "en" and by[7].score == 1.0  # the only language
    empty = language.train(no_docs)
    got = odd_docs.select(language.language(empty, F.col("text")).alias("p")).select("p.lang").distinct().collect()
    assert [r.lang for r in got] == ["und"]
    assert no_docs.select(language.language(empty, F.col("text"))).count() == 0


def test_families_then_languages(spark):
    # four languages in two families and one outside, told apart by their letters
    letters = {"en": "abcde", "de": "abcdf", "fr": "ghijk", "es": "ghijl", "xx": "mnopq"}
    rows = [
        (k * 100 + i, " ".join(own[(i + j) % 5] + own[(i * j) % 5] for j in range(30)), lang)
        for k, (lang, own) in enumerate(letters.items())
        for i in range(30)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert {f: sorted(v) for f, v in model.families.items()} == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    got = docs.select("lang", language.language(model, F.col("text")).alias("p")).select("lang", "p.*").collect()
    assert sum(r[0] == r[1] for r in got) >= 0.95 * len(got)


def test_letters_beyond_the_basic_plane():
    assert len(language.grams("\U0001f600 12 !?")) == 0  # signs, no letters
    assert len(language.grams("\U00010400")) > 0  # a letter


def test_rows_without_id_and_repeated_rows_are_sampled(spark, monkeypatch):
    """The sample is bounded, and neither null ids nor one repeated row fill it."""
    rows = [(i, f"plain words{i} of a long story", "en") for i in range(2000)]
    rows += [(None, f"null{i} id", "en") for i in range(1000)]
    rows += [(-1 - k, f"repeated {k}", "en") for k in range(20) for _ in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(language, "grams", lambda text: seen.append(text) or language.np.arange(3))
    language.train(docs, per_language=200)
    assert len(seen) == 200 and len(set(seen)) == 200
    without_id = sum(t.startswith("null") for t in seen)
    assert 30 <= without_id <= 105  # a third of the distinct rows
    assert sum(t.startswith("repeated") for t in seen) <= 20
    got = []
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda df: got.append(collect(df)) or got[-1])
    language.train(docs, per_language=200)
    assert max(map(len, got)) <= 400
