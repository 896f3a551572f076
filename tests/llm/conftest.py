import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    def make(rows, schema=DOCS):
        full = [(*r, *([None] * (len(schema.split(",")) - len(r)))) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
