import zlib

from pyarrow.fs import FileSelector
from test_packing import PATH, ids, packed

from countflow.llm.token_files import ShardReader, op10_token_files, open_dir, read, write
from countflow.session import shared_dir


def test_token_files_query(spark, sf, docs):
    rows = sorted(op10_token_files(spark, sf).collect(), key=lambda r: r["doc_id"])
    at = 0
    for r, d in zip(rows, sorted(docs.collect(), key=lambda d: d["doc_id"]), strict=True):
        want = [*ids(d["text"]), 2]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], at, len(want), zlib.crc32(packed(want)))
        at += len(want)


def test_token_files_with_odd_rows(spark, clashing, none, tmp_path):
    at = f"{shared_dir(spark)}/odd"
    manifest = write(clashing, "doc_id", "text", PATH, 2, at)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == clashing.count()
    rows = read(clashing, "doc_id", manifest, at).collect()
    want = sorted((str(r["doc_id"]), packed([*ids(r["text"]), 2])) for r in clashing.collect())
    assert sorted((str(r["doc_id"]), bytes(r["ids"])) for r in rows) == want
    assert read(spark.createDataFrame([(777,)], "doc_id long"), "doc_id", manifest, at).count() == 0
    empty = write(none, "doc_id", "text", PATH, 2, f"{at}-none")
    assert empty.count() == 0 and read(clashing, "doc_id", empty, f"{at}-none").count() == 0


def test_reader_refuses_absent_keys(spark, docs):
    at = f"{shared_dir(spark)}/plain"
    shard = write(docs, "doc_id", "text", PATH, 2, at).first()
    fs, root = open_dir(at)
    reader = ShardReader(fs, f"{root}/{shard['stem']}")
    assert not any(reader.find(list(range(10**6, 10**6 + 2000))))
    text = docs.filter(docs["doc_id"] == shard["first_key"]).first()["text"]
    assert reader.ids(reader.find([shard["first_key"]])[0][0]).tolist() == [*ids(text), 2]


def test_ids_are_written_to_their_files_only(spark, docs):
    """No copy of the ids waits in a checkpoint: texts are encoded on their way to their shard."""
    fs, root = open_dir(spark.sparkContext._jsc.sc().getCheckpointDir().get())
    rdds = lambda: {f.path for f in fs.get_file_info(FileSelector(root)) if "/rdd-" in f.path}
    before = rdds()
    write(docs, "doc_id", "text", PATH, 2, f"{shared_dir(spark)}/direct")
    assert rdds() == before
