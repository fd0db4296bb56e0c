"""The registered queries: names, columns, SQL, and the pipeline against brute force."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from maskflow.llm import contamination, fingerprints, mixing
from maskflow.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1": "doc_id held_out lang_pred score rejected",
    "op2": "page_id payload_bytes payload_digest record_type refers_to",
    "op3": "doc_id n_dropped clean_bytes clean_sha256",
    "op4": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op5": "doc_id item_id score question_overlap answer_overlap",
    "op6": "vec_id n_links component_id kept",
    "op7": "doc_id fingerprint component_id",
    "op8": "doc_id held_out score predicted",
    "op9": "doc_id size source_size target taken",
    "op10": "doc_id size text_crc32 law shard slot grown_shard",
    "op11": "page_id host path rule verdict",
    "op12": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op13": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in sorted(QUERIES, key=lambda n: int(re.search(r"\d+", n)[0]))] == list(COLUMNS)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_personal_data", "op8_quality", "op1_language_id"}))
def test_columns_and_reruns(spark, folder, name):
    first = QUERIES[name](spark, folder)
    assert first.columns == COLUMNS[name.split("_")[0]].split()
    rows = Counter(map(str, first.collect()))
    assert rows and Counter(map(str, QUERIES[name](spark, folder).collect())) == rows


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, folder, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, folder)
    found = connection.execute(f"SELECT {', '.join(df.columns)} FROM ({SQL[name]})")
    kinds = {str(c[0]): str(c[1]) for c in found.description}
    assert list(kinds) == df.columns
    assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in df.collect())


def test_fingerprints_of_documents(spark, folder):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_simhash_dedup"](spark, folder).collect()
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    assert prints == {k: fingerprints.fingerprint(t) for k, t in texts.items()}
    low = {k: k for k in prints}
    changed = True
    while changed:  # spread the smallest id over links until nothing changes
        changed = False
        for a in prints:
            near = min(low[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3)
            changed |= near < low[a]
            low[a] = min(low[a], near)
    assert {r["doc_id"]: r["component_id"] for r in rows} == low


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [len(stage) for stage in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None
    stages = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/{folder.replace('/', '-')}-{len(stages)}"
        stage(spark, stages[-1], folder).write.mode("overwrite").parquet(path)
        stages.append(spark.read.parquet(path))
        assert stages[-1].columns[: len(columns)] == columns
    raw, good, single, clean, mixed, dealt = [df.collect() for df in stages]

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    for label, share in ((0, 0.1), (1, 0.9)):
        own = [k for k, quality in labels.items() if quality == label]
        stay = sum(k in kept for k in own) / len(own)
        assert stay <= share if label == 0 else stay >= share

    prints = {r["doc_id"]: fingerprints.fingerprint(r["text"]) for r in good}
    stays = {r["doc_id"] for r in single}
    assert len(single) == len(stays)
    left = set(prints)
    while left:  # groups, by comparing all with all
        open_, group = [left.pop()], set()
        while open_:
            a = open_.pop()
            group.add(a)
            near = {b for b in left if (prints[a] ^ prints[b]).bit_count() <= 3}
            left -= near
            open_ += near
        assert stays & group == {min(group)}

    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    items = [contamination.Item.of(str(r["item_id"]), r["text"]) for r in items]

    def leaks(text):
        words = contamination.words_of(text)
        grams = {n: set(zip(*(words[k:] for k in range(n)))) for n in range(1, 6)}
        for item in items:
            shares = [len(p & grams[len(next(iter(p)))]) / len(p) if p else 1.0 for p in item.wanted()]
            if min(shares[:2]) >= 0.8 or (item.prose and shares[2] >= 0.8):
                return True
        return False

    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single if not leaks(r["text"])}

    plan = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix_digests(stages[3]).collect()}
    times = Counter(r["doc_id"] for r in mixed)
    assert all(times[k] * size == taken for k, (size, taken) in plan.items() if size)
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in clean}

    assert Counter(tuple(r)[: len(columns)] for r in dealt) == Counter(map(tuple, mixed))
    for number in range(40):
        slots = sorted(r["slot"] for r in dealt if r["shard"] == number)
        assert slots == list(range(len(slots)))
    assert len({(r["doc_id"], r["shard"]) for r in dealt}) == len({r["doc_id"] for r in dealt})

    run = corpus_pipeline.run(spark, folder)
    assert Counter(map(str, run.collect())) == Counter(map(str, dealt))


@pytest.fixture
def odd_folder(spark, folder, tmp_path):
    """Tables with nulls in every column, empty and very long texts, repeated rows, columns
    with clashing names and a map, beside those of the given ones."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (90_001, "", "en", "web", 0),
        (90_002, None, "en", None, None), (90_003, "one two three four five six " * 60_000, None, "web", 1),
        (None, "A text without a number. " * 30, "en", "web", 700), (90_004, "A text that is there twice. " * 30, "en", "x", 5),
        (90_004, "A text that is there twice. " * 30, "en", "x", 5), (90_005, "  \n\t ", "", "", -1),
    ]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    names = ("score", "features", "fp", "row", "doc", "key", "_size", "_draw", "salt", "shard", "slot", "_order", "matches", "size")
    for name in names:
        docs = docs.withColumn(name, F.lit(name))
    docs = docs.withColumn("bag", F.create_map(F.lit("a"), F.col("doc_id")))
    docs.repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    for table in ("labels", "benchmark"):
        own = spark.read.parquet(f"{folder}/{table}.parquet")
        nulls = spark.createDataFrame([tuple(None for _ in own.columns)], own.schema)
        own.unionByName(own.limit(3)).unionByName(nulls).write.parquet(str(tmp_path / f"{table}.parquet"))
    return str(tmp_path)


def test_pipeline_with_odd_rows(spark, odd_folder):
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    stages = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{odd_folder}/stage-{number}"
        stage(spark, stages[-1], odd_folder).write.parquet(path)
        stages.append(spark.read.parquet(path))
        own = stages[-1].columns
        # Sharding replaces the columns it adds.
        assert own == docs.columns or (number == 4 and sorted(own) == sorted(docs.columns))
    good, single, clean, mixed, dealt = stages[1:]
    for before, after in ((docs, good), (good, single), (single, clean)):
        left = Counter(str(r) for r in after.collect())
        assert not left - Counter(str(r) for r in before.collect())
    assert single.groupBy("doc_id", "text").count().where("count > 1").count() == 0
    taken = mixing.mix_digests(clean).agg(F.sum("taken")).first()[0]
    assert mixed.select(F.sum(F.size(F.split(F.trim("text"), r"[ \\t\\n\\x0b\\f\\r]+")))).first()[0] >= taken > 0
    assert dealt.count() == mixed.count()
    for number, slots in dealt.groupBy("shard").agg(F.sort_array(F.collect_list("slot"))).collect():
        assert slots == list(range(len(slots)))
    assert corpus_pipeline.run(spark, odd_folder).count() == dealt.count()


def test_pipeline_with_empty_tables(spark, folder, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").where("false").write.parquet(str(tmp_path / f"{table}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"shard", "slot"} <= set(out.columns)


def test_operators_with_odd_rows(spark, odd_folder):
    """The queries over documents that have rows and columns of every kind."""
    docs = spark.read.parquet(f"{odd_folder}/documents.parquet")
    want = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    for name in sorted(QUERIES):
        if name in ("op2_warc", "op5_decontamination", "op6_embedding_dedup", "op11_url_filter", "op4_personal_data"):
            continue
        found = QUERIES[name](spark, odd_folder)
        assert Counter(r["doc_id"] for r in found.select("doc_id").collect()) == want, name
    ids = {r["doc_id"] for r in QUERIES["op5_decontamination"](spark, odd_folder).collect()}
    assert ids <= set(want)
