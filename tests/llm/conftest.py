import pytest

SF0001 = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def folder_of(spark, tmp_path_factory):
    """Write rows as a table; returns the folder a query takes."""
    def write(name, rows, schema):
        path = tmp_path_factory.mktemp(name)
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
        return str(path)
    return write


@pytest.fixture(scope="session")
def texts(spark):
    rows = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}
