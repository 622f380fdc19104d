import os
import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from strataframe.llm import language, pieces
from strataframe.llm.common import DOCUMENT_COLUMNS
from tests.llm.test_mixing import water_fill
from tests.llm.test_near_dup import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(None, "und der die schung eit ich von", "de", None, 5), (900_001, None, "en", "src0", 0), (900_002, "12 34!", "en", "src0", 6), (900_003, "", None, None, None), (900_004, "The the and of hation mail to Mary Johnson or und.34@mail7.example.com now", "en", None, 3)]
    docs = docs.unionByName(spark.createDataFrame(extra + extra[-1:] * 2, docs.schema))
    out = [[tuple(r) for r in docs.select(*DOCUMENT_COLUMNS).collect()]]
    for k, (_, stage) in enumerate(cp.STAGES):
        docs = cp.materialize(stage(spark, docs, SF), "test-stage")
        if k < len(cp.STAGES) - 1:
            assert docs.columns == list(DOCUMENT_COLUMNS)
        out.append([tuple(r) for r in docs.collect()])
    return out


def test_language_keeps_what_is_recognised(spark, outputs):
    before, after = outputs[:2]
    model = language.fit(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long"))
    verdict = [(r, model.predict(r[1])) for r in before]
    assert Counter(after) == Counter(r for r, (lang, score) in verdict if lang != "und" and score >= model.reject_below)
    assert len(after) > 0.97 * len(before) - 4


def test_one_document_of_each_group_stays(outputs):
    before, after = outputs[1:3]
    found = brute([(r[0], r[1]) for r in before], percent=80)
    groups = {least for _, n, least, _ in found if n}
    assert Counter(r[0] for r in after) == Counter(groups) and set(after) <= set(before)


def test_entities_go_and_the_rest_stays(outputs):
    before, after = ({r[0]: r for r in rows} for rows in outputs[2:4])
    assert before.keys() == after.keys()
    entity = re.compile(r"\S+@\S+\.\w+|(?<!\d)\d{16}(?!\d)|\+1 \(\d{3}\) \d{3}-\d{4}|\d+\.\d+\.\d+\.\d+|[0-9a-fA-F]{40}|Mary Johnson")
    seen = 0
    for i, row in before.items():
        old, new = entity.findall(row[1]), after[i][1]
        seen += len(old)
        assert not [e for e in old if e in new] and len(entity.findall(new)) == len([e for e in old if e != "Mary Johnson"])
        assert old or new == row[1]
        assert after[i][2:4] == row[2:4]
    assert seen > 20


def test_sources_reach_their_targets(outputs):
    before, after = outputs[3:5]
    sizes = Counter()
    for r in before:
        sizes[r[3]] += len(words(r[1]))
    want, taken, by_id = water_fill(dict(sizes), (5, 2, 1)), Counter(), {r[0]: r for r in before}
    for r in after:
        taken[r[3]] += len(words(r[1]))
        whole = by_id[r[0]]
        assert (r == whole) or (whole[1].startswith(r[1]) and r[2:4] == whole[2:4] and r[4] == len(r[1]))
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    assert max(Counter(r[0] for r in after).values()) <= 3


def test_pieces_are_those_of_the_public_coder(outputs):
    import sentencepiece

    coder = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    want = Counter((i, lang, source, len(ids := coder.encode(text)), tuple(ids)) for i, text, lang, source, _ in outputs[4])
    assert Counter((*r[:4], tuple(r[4])) for r in outputs[5]) == want


def test_ids_are_decoded(outputs):
    assert Counter((r[0], r[5]) for r in outputs[5]) == Counter((r[0], r[1].replace(pieces.MARK, " ")) for r in outputs[4])


def test_run_equals_the_stages(spark, outputs):
    assert cp.run(spark, SF).count() > 100


def test_empty_table(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() == 0


def test_scratch_of_done_stages_goes(spark):
    docs = spark.createDataFrame([(1, "a mail to u.1@mail.example.com now", "en", "s", 34)], "doc_id long, text string, lang string, source string, n_chars long")
    first = cp.pii_surrogates(spark, docs, SF)
    made = list(cp._SCRATCH)
    chained = cp.sentencepiece(spark, first, SF)
    assert made and set(made) <= set(cp._SCRATCH) and chained.count() == 1
    cp.sentencepiece(spark, docs, SF)
    assert not set(made) & set(cp._SCRATCH)
