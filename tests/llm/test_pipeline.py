"""The pipeline, stage by stage and as a whole, against plain Python."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from test_line_dedup import brute as brute_lines
from test_line_dedup import learn_hashes
from test_mixing import simulate
from test_simhash import brute as brute_groups
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from changeflow.llm.mixing import BLOCK_ROWS, POWER
from changeflow.llm.quality import fit

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def by_hand(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit(spark, table, spark.read.parquet(f"{folder}/labels.parquet"))
    docs = [r for r in table.collect() if model.score(r["text"]) >= 0.7]

    learn_hashes(spark, [(r["doc_id"], r["text"]) for r in docs])
    new = {i: (text, gone) for i, text, gone in
           map(eval, brute_lines([(r["doc_id"], r["text"]) for r in docs]))}
    docs = [(r["doc_id"], new[r["doc_id"]][0], r["lang"], r["source"],
             len(new[r["doc_id"]][0]) if new[r["doc_id"]][1] else r["n_chars"]) for r in docs]

    groups = {i: head for i, _, head in map(eval, brute_groups([(d[0], d[1]) for d in docs]))}
    docs = [d for d in docs if groups[d[0]] == d[0]]

    order = spark.createDataFrame(docs, table.schema).selectExpr(
        "doc_id", "xxhash64(doc_id, text, lang, source, n_chars) AS h").collect()
    hashes = dict(map(tuple, order))
    sources = defaultdict(list)
    for d in sorted(docs, key=lambda d: hashes[d[0]]):
        sources[d[3]].append(d)
    sizes = {s: len(own) for s, own in sources.items()}
    slots, blocks = simulate(sizes, {s: n ** POWER for s, n in sizes.items()}, BLOCK_ROWS)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for source, block, *_ in slots:
        for n, d in enumerate(sources[source]):
            if n * blocks[source] // sizes[source] == block:
                ids = tokenizer.encode(d[1], add_special_tokens=False).ids
                out.append((d[0], d[2], d[3], d[4], len(ids), ids, True))
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_whole(spark, folder):
    got = entry_points.queries()["pipeline"](spark, folder)
    want = by_hand(spark, folder)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert len({r[0] for r in want}) > 100


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "SimHash near-dedup",
                     "mixing sources to target weights", "BPE encoding and decoding"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.columns == COLUMNS and made.dtypes == docs.dtypes, name
        assert {r["doc_id"] for r in made.select("doc_id").collect()} <= {
            r["doc_id"] for r in docs.select("doc_id").collect()}
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_stages_bear_odd_rows(spark, sf_dir):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
            (2, "word " * 50_000, "xx", None, 250_000), (3, None, "en", "s", None)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    kept = Counter()
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = stage(spark, docs, sf_dir).count()
    assert kept["line dedup"] == kept["BPE encoding and decoding"] == len(rows)
    assert kept["SimHash near-dedup"] == 2
    assert kept["mixing sources to target weights"] >= len(rows)
