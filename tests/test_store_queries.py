"""Sizes that the stored-path queries choose by their tables."""

from casemill.plans import store_queries

SF = "/root/testdata/sf0.001"


def test_an_export_has_more_files_as_its_tables_grow(spark, monkeypatch):
    assert store_queries._export_files(spark, SF, ["documents"], 3) == 3
    monkeypatch.setattr(store_queries, "EXPORT_BYTES", 20_000)
    sizes = {}
    write = store_queries.write_delimited

    def counted(rows, path):
        write(rows, path)
        texts = rows.sparkSession.read.text(path).select("_metadata.file_path").distinct()
        sizes[path.rpartition("/")[2]] = texts.count()

    monkeypatch.setattr(store_queries, "write_delimited", counted)
    found = store_queries.delimited_round_trip(spark, SF).count()
    assert sizes["texts"] > 3 and found > 0
    monkeypatch.undo()
    assert store_queries.delimited_round_trip(spark, SF).count() == found


def test_a_stream_of_more_files_keeps_its_batches(spark, monkeypatch):
    expected = {tuple(r) for r in store_queries.streamed_intake(spark, SF).collect()}
    monkeypatch.setattr(store_queries, "EXPORT_BYTES", 20_000)
    asked = []
    start = store_queries.start_intake

    def counted(*args, files_per_batch):
        asked.append(files_per_batch)
        return start(*args, files_per_batch=files_per_batch)

    monkeypatch.setattr(store_queries, "start_intake", counted)
    assert {tuple(r) for r in store_queries.streamed_intake(spark, SF).collect()} == expected
    assert min(asked) > 2
