import zlib
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
import zstandard

from changeflow.llm.quality import DOC_BYTES, Model, _all_over, fit, good_documents, rising, scored
from changeflow.llm.queries import RUNS


def test_rising():
    marks, scores = rising([(-2, 10, 0), (0, 10, 8), (1, 10, 4), (5, 100, 100)], 0.5)
    assert marks == [-0.5 / 500, 4.5 / 500]
    assert scores == pytest.approx([0.5 / 11, 12.5 / 21, 100.5 / 101])
    assert rising([], 0.3) == ([], [0.3])


@pytest.mark.parametrize("folder, good, bad", [("/root/testdata/sf0.01", 0.92, 0.75),
                                                ("/root/testdata/sf0.1", 0.97, 0.92)])
def test_held_out_accuracy(spark, folder, good, bad):
    got = {r["doc_id"]: r for r in RUNS["op10_quality"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
               for r in got.values())
    tested = [(r["quality"], got[r["doc_id"]]["predicted"]) for r in labels
              if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    for quality, least in ((1, good), (0, bad)):
        own = [p == q for q, p in tested if q == quality]
        assert sum(own) / len(own) >= least, (quality, len(own), sum(own))


def plain_difference(model, text):
    """Bytes saved per byte and the bytes of a text, piece by piece, by new compressors."""
    kind = zstandard.DICT_TYPE_AUTO if model.trained else zstandard.DICT_TYPE_RAWCONTENT
    raw, sizes = text.encode(), []
    for content in (model.bad, model.good):
        total = 0
        for at in range(0, len(raw), 2048):
            plain = zstandard.ZstdCompressionParameters.from_level(
                3, write_content_size=False, write_checksum=False, write_dict_id=False)
            tool = zstandard.ZstdCompressor(compression_params=plain, dict_data=(
                zstandard.ZstdCompressionDict(content, dict_type=kind)))
            total += len(tool.compress(raw[at:at + 2048]))
        sizes.append(total)
    return (sizes[0] - sizes[1]) / max(len(raw), 1), len(raw)


def plain_scores(model, docs, labels):
    """Every document's score, from the two dictionaries and the labels of fold 3 alone.

    The isotonic curve is found as the largest mean of any run that ends at or after a
    bin and the smallest of any that begins there, not by merging neighbours.
    """
    known = {i: plain_difference(model, t or "") for i, t in docs}
    ones = [q for i, q in labels if i in known and q in (0, 1)
            and zlib.crc32(str(i).encode()) % 4 == 3]
    share = sum(ones) / len(ones)
    scores = {}
    for low, high in ((0, 64), (64, 256), (256, 1 << 60)):
        bins = {}
        for i, q in labels:
            if i in known and q in (0, 1) and zlib.crc32(str(i).encode()) % 4 == 3 \
                    and low <= known[i][1] < high:
                bins.setdefault(int(Decimal(known[i][0] * 500).quantize(0, ROUND_HALF_UP)), []).append(q)
        steps = sorted(bins)
        n, k = [len(bins[s]) for s in steps], [sum(bins[s]) for s in steps]
        level = [max(min(Fraction(sum(k[a:b + 1]), sum(n[a:b + 1])) for b in range(m, len(steps)))
                     for a in range(m + 1)) for m in range(len(steps))]
        curve = []
        for value in sorted(set(level)):
            own = [m for m in range(len(steps)) if level[m] == value]
            rows, good = sum(n[m] for m in own), sum(k[m] for m in own)
            curve.append(((steps[own[0]] - 0.5) / 500, (good + share) / (rows + 1)))
        for i, (difference, size) in known.items():
            if low <= size < high:
                fit = [s for mark, s in curve[:1] + [c for c in curve[1:] if c[0] <= difference]]
                scores[i] = max(fit) if fit else share
    return scores


def test_scores_against_a_plain_computation(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    model = fit(spark, docs, labels)
    want = plain_scores(model, [tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    got = {r["doc_id"]: r["score"] for r in scored(spark, docs, model).collect()}
    assert sorted(got) == sorted(want) and len(set(want.values())) > 3
    assert all(got[i] == pytest.approx(want[i], abs=1e-12) for i in want)


def test_samples_come_from_all_over_a_long_text(spark):
    text = "".join(chr(97 + i // 1000) * 1000 for i in range(0, 26_000, 1000)) * 5
    rows = spark.createDataFrame([(text,), ("short é",), ("",)], "text string") \
        .selectExpr("encode(text, 'UTF-8') AS raw").select(_all_over("raw").alias("head")).collect()
    whole, short, empty = (bytes(r["head"]) for r in rows)
    assert len(whole) == DOC_BYTES and short == "short é".encode() and empty == b""
    raw = text.encode()
    assert whole[:2048] == raw[:2048] and whole[-2048:] == raw[-2048:]
    assert len(set(whole)) > 10 and all(whole[at:at + 2048] in raw for at in range(0, DOC_BYTES, 2048))


def test_labels_of_the_held_out_fold_do_not_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "IF(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, 1 - quality, quality) "
        "AS quality")
    one, other = fit(spark, docs, labels), fit(spark, docs, turned)
    assert (one.good, one.bad, one.curves) == (other.good, other.bad, other.curves)


def test_odd_rows(spark):
    junk = " ".join(f"BUY{i % 7}!!" for i in range(60))
    rows = [(i, f"{i} the calm river runs by the old town and out to sea {i * i}" if i % 2 else
             f"{junk} {i}", "s", 1.5) for i in range(400)]
    rows += [(None, None, "s", 2.5), (400, "", None, 2.5), (400, "", None, 2.5),
             (401, "the calm river runs " * 20_000, "s", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, SCORE string, read double")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(400)] + [(None, 1), (3, None), (5, 7)],
        "doc_id bigint, quality int")
    model = fit(spark, docs, labels)
    got = scored(spark, docs, model)
    assert got.columns == ["doc_id", "text", "read", "score"]
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert got.count() == len(rows)
    assert all(0 <= s <= 1 for s in scores.values())
    assert sum((scores[i] >= 0.5) == (i % 2 == 1) for i in range(400)) > 380
    kept = good_documents(spark, docs, labels, keep_from=0.5)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.5}
    assert scored(spark, docs.limit(0), model).collect() == []


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(i, 1) for i in range(50)]])
def test_missing_classes_give_the_share(spark, labels):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id bigint, text string")
    model = fit(spark, docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    scores = {r["score"] for r in scored(spark, docs, model).collect()}
    assert len(scores) == 1 and scores <= {0.5, 1.0}
    assert isinstance(model, Model)
