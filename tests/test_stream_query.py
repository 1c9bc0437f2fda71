"""The streamed text index on tables kept as one file and as a folder of files."""

import pytest

from doclake.queries.loading import text_index_stream


@pytest.mark.parametrize("files", [0, 3])
def test_documents_as_file_or_folder(spark, tmp_path, files):
    table = tmp_path / "documents.parquet"
    docs = spark.createDataFrame([(i, f"one two{i} one") for i in range(6)], "doc_id bigint, text string")
    if files:
        docs.repartition(files).write.parquet(str(table))
    else:
        docs.toPandas().to_parquet(table)
    docs.limit(0).write.parquet(str(tmp_path / "others.parquet"))
    got = {(r.token, r.id): r.tf for r in text_index_stream(spark, str(tmp_path)).collect()}
    assert got == {("one", i): 2 for i in range(6)} | {(f"two{i}", i): 1 for i in range(6)}
