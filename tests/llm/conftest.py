import pytest
from tests.llm import fixtures


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(fixtures.rows(), fixtures.SCHEMA)


@pytest.fixture(scope="session")
def sf_dir(spark, awkward, tmp_path_factory):
    """The smallest sample, its documents joined by the awkward rows."""
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{fixtures.SF}/documents.parquet")
    low = docs.selectExpr("max(doc_id) + 1").first()[0]
    more = awkward.selectExpr(f"doc_id + {low} AS doc_id", "text", "lang", "source", "n_chars")
    docs.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{fixtures.SF}/benchmark.parquet").unionByName(
        spark.createDataFrame(
            [(9001, "p1y p2z p3x"), (9002, None), (9003, ""), (9004, "one"), (9005, fixtures.PASSAGE), (9005, "?!")],
            "item_id long, text string",
        )
    ).write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{fixtures.SF}/pages.parquet").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def items(spark, sf_dir):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
