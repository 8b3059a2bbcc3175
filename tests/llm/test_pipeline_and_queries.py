import oracle
import pytest

import corpus_pipeline
from starflow.llm.oracles import ORACLES
from starflow.llm.queries import QUERIES

COLUMNS = {
    "op1_mix_sources": "doc_id size source_size target taken",
    "op2_class_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op5_simhash_dedup": "doc_id fingerprint component_id",
    "op6_url_rules": "page_id host path rule verdict",
    "op7_token_files": "doc_id start n_tokens ids_crc32",
    "op8_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op9_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_toxicity": "doc_id held_out score predicted",
    "op11_spelling_variants": "word form root n n_near form_n",
    "op12_source_divergence": "lang source part item value rank",
    "op13_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
}


def test_every_operator_has_a_query():
    assert list(QUERIES) == list(COLUMNS)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    assert oracle.compare(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", [n for n in COLUMNS if n[:4] not in ("op11", "op12")])
def test_query_returns_a_row_for_every_row(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name].split()) <= set(found.columns)
    table, key = ("pages", "page_id") if name.startswith("op6") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in found.select(key).collect()} == ids


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage left, stage by stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return out


def test_stages_call_the_dealt_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_dedup", "mixing", "packing",
    ]


def test_filters_keep_whole_rows(stages):
    documents = {r["doc_id"]: tuple(r) for r in stages[0].collect()}
    for docs in stages[1:4]:
        assert docs.columns == stages[0].columns
        kept = docs.collect()
        assert len({r["doc_id"] for r in kept}) == len(kept)
        assert all(documents[r["doc_id"]] == tuple(r) for r in kept)
    sizes = [d.count() for d in stages[:4]]
    assert sizes == sorted(sizes, reverse=True) and sizes[1] > 0.8 * sizes[0]


def test_each_filter_does_its_work(spark, stages, workspace):
    from test_simhash import brute

    toxic, exact, near = stages[1:4]
    texts = {}
    for r in toxic.collect():
        texts[r["text"]] = max(r["doc_id"], texts.get(r["text"], -1))
    assert {r["doc_id"] for r in exact.collect()} == set(texts.values())
    rows = [(r["doc_id"], r["text"], "s") for r in exact.collect()]
    assert {r["doc_id"] for r in near.collect()} == {c for _, _, c in brute(rows)}


def test_mix_and_packs_of_the_pipeline(stages):
    import zlib

    from starflow.llm.tokens import encoder, tokenizer_path

    near, mixed, packed = (d.collect() for d in stages[3:])
    whole = {r["doc_id"]: r["text"] for r in near}
    words = sum(len(r["text"].encode().split()) for r in near)
    taken = sum(len(r["text"].encode().split()) for r in mixed)
    assert abs(taken - 1.5 * words) <= 25
    assert all(whole[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in mixed)
    encode = encoder(tokenizer_path()).encode
    expected = []
    for r in mixed:
        ids = encode(r["text"]) + bytes(4)
        first = (len(ids) // 4 - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) // 4 + 1, 2048)]
        expected += [(r["doc_id"], k, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(expected) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in packed)
    filled = {}
    for r in packed:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    total = sum(filled.values())
    assert max(filled.values()) <= 2048 and len(filled) <= -(-total // 2048) + 1


def test_run_gives_the_rows_of_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32")
    expected = stages[-1].select(*got.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
