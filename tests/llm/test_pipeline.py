"""Each stage against brute force on its own input, and the run against its stages."""

import collections
import random
import re

import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from docketflow.llm import minhash, mixing
from docketflow.llm.common import piece_model
from docketflow.llm.quality_rules import BANDS, CHUNK_BYTES, MAX_BAD_CHUNKS

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    letters = "etaoinshrdlu"
    word = lambda: "".join(rng.choices(letters, k=rng.randint(2, 9)))
    rows = []
    for k in range(160):
        source = rng.choice(["a", "a", "b", "c", None])
        lines = [" ".join(word() for _ in range(rng.randint(15, 40))) for _ in range(rng.randint(3, 8))]
        if rng.random() < 0.3:
            lines.insert(1, f"imprint and contact of site {source}")
        rows.append([k, "\n".join(lines), "en", source, 0])
    for k in range(25):  # exact and near copies
        text = rows[k][1].split(" ")
        if k % 2:
            text[5] = "changed"
        rows.append([500 + k, " ".join(text), "en", rows[k][3], 0])
    rows += [[700, None, "en", "a", None], [701, "", None, "b", 0], [702, "word " * 500, "en", "c", 0],
             [703, "too short", "en", "c", 0], [None, rows[40][1] + "\nmore", "en", "a", 0]]
    rows += [list(rows[50])]
    # Prose with a rest of noise, which only the rest's own band tells.
    signs = [chr(c) for c in range(0x21, 0x7F)]
    noise = " ".join("".join(rng.choices(signs, k=12)) for _ in range(180))
    prose = " ".join(" ".join(word() for _ in range(30)) + "." for _ in range(40))[: CHUNK_BYTES + 400]
    rows += [[710, prose + " " + noise, "en", "a", 0], [711, prose, "en", "a", 0]]
    out = tmp_path_factory.mktemp("sf")
    docs = spark.createDataFrame([tuple(r) for r in rows], COLUMNS)
    docs.write.parquet(str(out / "documents.parquet"))
    return str(out)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Input and output rows of each stage, in order."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        found.append((name, docs.collect(), rows, out.columns))
        docs = spark.createDataFrame(rows, out.schema)
    return found


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def is_good(text):
    text = text or ""
    own = re.findall(WORD, text)
    windows = list(zip(own, own[1:], own[2:]))
    seen = collections.Counter(windows)
    covered = {k + d for k, w in enumerate(windows) if seen[w] > 1 for d in range(3)}
    if len(own) < 50 or 100 * len(covered) > 50 * len(own):
        return False

    def fits(part):
        low, high = next((a, b) for n, a, b in reversed(BANDS) if len(part) >= n)
        return low <= len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part) <= high

    data = text.encode()
    chunks = [data[k : k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]
    # A rest is judged alone and as the end of the last bytes of full size.
    bad = [not fits(c) or k > 0 and len(c) < CHUNK_BYTES and not fits(data[-CHUNK_BYTES:]) for k, c in enumerate(chunks)]
    return fits(data) and sum(bad) <= MAX_BAD_CHUNKS * len(bad)


def test_all_but_the_last_return_documents(stages):
    for _, _, _, columns in stages[:-1]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage(stages):
    _, before, after, _ = stages[0]
    assert in_order(after) == in_order(r for r in before if is_good(r.text))
    assert len(after) < len(before)


def test_a_bad_rest_is_rejected(stages):
    _, before, after, _ = stages[0]
    kept = {r.doc_id for r in after}
    assert {710, 711} <= {r.doc_id for r in before} and 710 not in kept and 711 in kept


CLASHING = (
    "key size order passes taken node label class_id best site nameless line n id doc first shared kept"
    " words band cut more whole slice unit row"
).split()


@pytest.mark.parametrize("k", range(5))
def test_extra_columns_stay_and_change_nothing(spark, stages, folder, k):
    name, before, after, columns = stages[k]
    plain = spark.createDataFrame(before, COLUMNS)
    more = plain.withColumns({x: F.lit(x) for x in CLASHING})
    out = corpus_pipeline.STAGES[k][1](spark, more, folder)
    extra = CLASHING if k < 4 else []
    assert out.columns == [*columns, *extra]
    rows = out.collect()
    assert in_order(tuple(r)[: len(columns)] for r in rows) == in_order(after)
    assert all(r[x] == x for r in rows for x in extra)


def test_an_empty_table_has_no_rows(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_without_text_only(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, None, "en", "a", 1)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_line_stage(stages):
    _, before, after, _ = stages[1]
    pages = collections.Counter(r.source for r in before)
    having = collections.Counter((r.source, x) for r in before for x in set((r.text or "").split("\n")))

    def clean(r):
        kept = [
            x for x in r.text.split("\n")
            if not re.search(WORD, x) or having[r.source, x] < 5 or having[r.source, x] <= 0.1 * pages[r.source]
        ]
        text = "\n".join(kept)
        return (r.doc_id, text, r.lang, r.source, len(text))

    assert in_order(after) == in_order(clean(r) for r in before)
    assert sum(len(r.text) for r in after) < sum(len(r.text) for r in before)


def test_near_duplicate_stage(stages):
    _, before, after, _ = stages[2]
    own = [minhash.shingles(r.text) for r in before]
    group = list(range(len(before)))
    for i in range(len(before)):
        for j in range(i):
            if group[i] != group[j] and own[i] and minhash.overlap(own[i], own[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    best = {}
    for g, r in zip(group, before):
        key = (r.doc_id is None, r.doc_id or 0, r.text)
        best[g] = min(best.get(g, key), key)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in after) == sorted(k[:2] for k in best.values())
    assert len(after) < len(before)


def test_mixing_stage(stages):
    _, before, after, _ = stages[3]
    copies = collections.Counter(map(tuple, after))
    assert set(copies) <= set(map(tuple, before)) and set(copies.values()) <= {1, 2}
    size = lambda rows: collections.Counter({
        s: sum(len(re.findall(WORD, r.text)) for r in rows if r.source == s) for s in {r.source for r in rows}
    })
    have, got = size(before), size(after)
    names = sorted(have, key=lambda s: (s is None, s or ""))
    for name, wanted in zip(names, mixing.targets([have[s] for s in names])):
        assert abs(got[name] - wanted) <= 3


def test_token_stage(stages):
    _, before, after, _ = stages[4]
    processor = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    coded = [(r.doc_id, processor.encode(r.text)) for r in before]
    assert in_order(after) == in_order((i, ids, processor.decode(ids)) for i, ids in coded)


def test_run_gives_the_rows_of_its_stages(spark, folder, stages):
    assert in_order(corpus_pipeline.run(spark, folder).collect()) == in_order(stages[-1][2])
