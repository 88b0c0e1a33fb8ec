"""The Merkle manifest, the divergence audit and packing against brute force and the libraries."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from pyspark.sql import functions as F

import check_oracle
from docketflow.llm import divergence, merkle, packing
from docketflow.llm.common import word_tokenizer
from docketflow.llm.oracle import ORACLE_SQL
from docketflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def frame(spark, rows, parts=3):
    """The rows with columns whose names clash with inner ones."""
    docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    clashing = (
        "tree rank hash n block kids kid path place part first own shift leaf tampered row arrival"
        " digit order0 root subroot term count docs counts total n_terms item value start length"
        " tokens open sequence_id offset doc_tokens group task"
    ).split()
    return docs.withColumns({name: F.lit(name) for name in clashing})


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def awkward(seed, sizes):
    rng = random.Random(seed)
    texts = [None, "", "Ab É Ä X", "x", "É\0<>\U0001f600", "Long WORD " * 30_000]
    weights = [3, 3, 9, 9, 3, 0.01]
    return [
        (rng.choice([None, *range(1000)]), source, rng.choice([None, "", "en"]),
         rng.choice([None, -5, 7]), rng.choices(texts, weights)[0])
        for source, n in sizes for _ in range(n)
    ]


# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    texts = ("" if x is None else str(x) for x in row)
    return H(*("-" if x is None else f"{len(t.encode())}:{t}" for x, t in zip(row, texts)))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def siblings(levels, i):
    for nodes in levels[:-1]:
        start = i // 16 * 16
        yield nodes[start:i], nodes[i + 1 : start + 16]
        i //= 16


def manifest_by_hand(rows):
    by_source = collections.defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for own in by_source.values():
        own.sort(key=lambda x: x[:3])
    trees = {s: levels_of([x[2] for x in by_source[s]]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    result = []
    for k, s in enumerate(order):
        for i, (_, _, leaf, row) in enumerate(by_source[s]):
            path = [*siblings(trees[s], i), *siblings(top, k)]
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = leaf_of((*row[:4], row[4] and row[4].translate(LOWER)))
            for left, right in path:
                node = H(*left, node, *right)
            proof = H(*(x for left, right in path for x in (*left, *right)))
            root = top[-1][0]
            result.append((row[0], leaf, trees[s][-1][0], root, proof, node, node == root))
    return sorted(result, key=repr)


MANY = [(None, 1), ("a", 700), ("b", 16), ("é", 17), ("", 300), *((f"s{k}", 1) for k in range(20))]


@pytest.mark.parametrize("digits", [1, 3])
@pytest.mark.parametrize("sizes", [MANY, [("only", 1)], [("a", 1), ("b", 1)], [("a", 4097)]])
def test_manifest(spark, monkeypatch, digits, sizes):
    monkeypatch.setattr(merkle, "BLOCK_DIGITS", digits)
    rows = awkward(len(sizes), sizes)
    rows += rows[:2]
    found = tuples(merkle.verified_manifest(frame(spark, rows)))
    assert found == manifest_by_hand(rows)


def test_manifest_tells_tampered_rows(spark):
    rows = [(k, "s", "en", 3, "Abc" if k % 2 else "abc") for k in range(200)]
    chosen = {k for k in range(200) if zlib.crc32(str(k).encode()) % 5 == 0}
    bad = {r.doc_id for r in merkle.verified_manifest(frame(spark, rows)).collect() if not r.verified}
    assert bad == {k for k in chosen if k % 2} and bad


def test_manifest_of_equal_rows_is_spread(spark):
    rows = [(None, "s", None, None, "same")] * 3000 + [(1, "t", "en", 1, "x")]
    assert tuples(merkle.verified_manifest(frame(spark, rows, 6))) == manifest_by_hand(rows)
    placed, largest = merkle.ranked(
        frame(spark, rows, 6).select(F.col("source").alias("tree"), "doc_id"), ["doc_id"]
    )
    assert largest == 3000 and placed.select("tree", "rank").distinct().count() == 3001
    # The equal rows lie in several range partitions.
    assert placed.groupBy(F.floor(F.col("rank") / 1000)).count().count() >= 3


def test_manifest_of_nothing(spark):
    assert tuples(merkle.verified_manifest(frame(spark, []))) == []


def test_paths_lead_to_the_root(spark):
    leaves = spark.range(600).select(
        F.col("id"), (F.col("id") % 7).cast("string").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("h")
    )
    found = merkle.proofs(merkle.build(leaves, "kind", ["id"], "h"))
    assert found.columns == ["id", "source", "leaf", "subroot", "root", "path"]
    wrong = found.filter(merkle.folded(F.col("leaf"), F.col("path")) != F.col("root"))
    assert found.count() == 600 and wrong.count() == 0


# Divergence


def audit_by_hand(rows, min_docs, top):
    docs = [
        (lang or "", source or "", [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")])
        for _, source, lang, _, text in rows
    ]
    result = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= min_docs}
        sources = sorted({d[1] for d in own})
        counts = {s: collections.Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in sources}
        whole = sum(counts.values(), collections.Counter())

        def weight(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            pairs = [
                (-sum(gap(weight(counts[s], t), weight(counts[o], t)) for t in kept), o.encode())
                for o in sources if o != s
            ]
            terms = [
                (-gap(weight(counts[s], t), weight(whole, t)), t.encode()) for t in kept
                if counts[s][t] and weight(counts[s], t) > weight(whole, t)
            ]
            for part, values, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(values)[:most], 1):
                    result.append((lang, s, part, item.decode(), -value, rank))
    return sorted(result, key=repr)


def words_of(seed, n):
    rng = random.Random(seed)
    voc = ["the", "The", "É", "é", "ab1cd", "x-y", "ß", "中文", "zz"] + [f"w{chr(97 + k)}" for k in range(20)]
    rows = []
    for k in range(n):
        source = rng.choice([None, "", "a", "B", "é"])
        text = " ".join(rng.choices(voc, range(1, len(voc) + 1) if source == "a" else None, k=rng.randint(0, 40)))
        rows.append((k, source, rng.choice([None, "en", "en", "de"]), 1, rng.choice([text, text, text, None, "1 2 3"])))
    return rows + [(1, "alone", "xx", 1, "few words"), (2, "bare", "xx", 1, None), (3, "long", "en", 1, "the É " * 60_000)]


@pytest.mark.parametrize("block_counts, min_docs", [(4_000_000, 10), (12, 3)])
def test_divergence(spark, monkeypatch, block_counts, min_docs):
    monkeypatch.setattr(divergence, "BLOCK_COUNTS", block_counts)
    rows = words_of(3, 300)
    rows += rows[:5]
    found = tuples(divergence.audit(frame(spark, rows), min_docs))
    assert found == audit_by_hand(rows, min_docs, 10)
    assert {r[2] for r in found} == {"pair", "term"}
    assert [r[4] for r in found if r[0] == "xx"] == [0, 0]


def test_divergence_of_nothing(spark):
    assert tuples(divergence.audit(frame(spark, []))) == []


def test_weights_are_exact_beyond_long(spark):
    big = 4 * 10**18
    expected = 1 + 10**9 * (big + 2) // (big + 10**18 + 2 * 10**7)
    df = spark.range(1).select(divergence.weight(F.lit(big), F.lit(big + 10**18), F.lit(10**7)).alias("p"))
    assert df.first().p == expected
    assert divergence.weights(np.array([big]), big + 10**18, 10**7)[0] == expected


def test_run_lengths_are_intersected():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        a, b = rng.integers(0, 3, n), rng.integers(0, 3, n)
        wa, wb = a * 10**8 + 1, b * 10**8 + 1
        columns = []
        for counts in (a, b):
            at = np.flatnonzero(counts)
            starts, values = divergence.encoded(at, counts[at], n)
            assert len(starts) == 1 + int((np.diff(counts) != 0).sum())
            columns.append((starts, values * 10**8 + 1))
        assert divergence.differ(*columns, n) == int(((wa - wb) ** 2 // (wa + wb)).sum())


# Packing


def check_packing(pieces, expected, end_id=1, size=2048):
    """All ids in their order, gapless sequences; the share of padding and documents cut though short."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        ids = np.frombuffer(r.tokens, "<u4").tolist()
        assert r.length == len(ids) > 0
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for doc_id, all_ids in expected.items():
        own = sorted(by_doc.pop(doc_id))
        found = [k for _, ids, _ in own for k in ids]
        total = sum(map(len, all_ids))
        if len(all_ids) == 1:
            assert found == all_ids[0] and all(n == total for *_, n in own)
            assert [s for s, *_ in own] == np.cumsum([0, *(len(ids) for _, ids, _ in own)])[:-1].tolist()
        else:  # rows of one id
            assert sorted(found) == sorted(k for ids in all_ids for k in ids)
    assert not by_doc
    padding = tokens = 0
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
        tokens += end
        padding += 0 if end & (end - 1) == 0 else size - end
    return padding / tokens


def ids_of(rows):
    library = tokenizers.Tokenizer.from_file(word_tokenizer())
    coded = library.encode_batch([r[4] or "" for r in rows], add_special_tokens=False)
    expected = collections.defaultdict(list)
    for row, ids in zip(rows, coded):
        expected[row[0]].append([*ids.ids, 1])
    return expected


STRANGE = [
    None, "", " \t\n\x0b\x0c\r ", " a  b ", "é\x1cx\x85y z   ▁a ▁▁b", "x" * 50_000, "É ́x ΑΣ Σ ΑΣ. İ",
    "\0 \U0001f600 <|endoftext|> a<|startoftext|>b", "it's 'S don't 12 1.5 --- ...", "한가 ﬁ Å",
    "don’t " * 9000, "one two three " * 700,
]


@pytest.mark.parametrize("parts, fan_in, open_windows", [(1, 64, 64), (7, 2, 3), (9, 64, 8)])
def test_packing(spark, parts, fan_in, open_windows):
    rng = random.Random(parts)
    rows = [(k, "s", "en", 1, text) for k, text in enumerate(STRANGE)]
    rows += [(100 + k, "s", "en", 1, " ".join(rng.choices(["alpha", "betagamma", "x", "Qq"], k=rng.randint(1, 1500)))) for k in range(300)]
    rows += [rows[-1], (None, "s", "en", 1, "no id")]
    pieces = packing.pack(
        frame(spark, rows, parts), word_tokenizer(), fan_in=fan_in, open_windows=open_windows
    ).collect()
    padding = check_packing(pieces, ids_of(rows))
    assert padding < 0.05


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, []), word_tokenizer()).collect() == []


def test_packer_takes_the_best_window_and_emits_the_fullest():
    packer = packing.Packer(0, 16, 2)

    def piece(n):
        return packing.Piece("d", 0, np.zeros(n, np.uint32), n)

    packer.place(piece(10))  # room 6
    packer.place(piece(7))  # room 9
    packer.place(piece(6))  # fills the first exactly
    assert [(r[2], r[4]) for r in packer.taken()] == [(10, 0), (6, 0)]
    packer.place(piece(12))  # room 4
    packer.place(piece(13))  # fits none: the window of 12 goes
    assert [r[2] for r in packer.taken()] == [12]
    assert [room for room, _ in packer.rooms] == [3, 9]
    packer.finish()  # 13 + 7 = 16 + 4
    rows = packer.taken()
    lengths = collections.Counter()
    for r in rows:
        lengths[r[4]] += r[2]
    assert list(lengths.values()) == [16, 4]


def test_word_table_equals_the_library():
    texts = STRANGE + ["a b c " * 5000]
    ids, bounds = packing.WordTable(word_tokenizer()).encode(pa.array(texts, pa.string()))
    library = tokenizers.Tokenizer.from_file(word_tokenizer())
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_small_tasks_of_one_worker_share_a_word_table(monkeypatch):
    made, learn = [], packing.WordTable.__init__

    def counted(self, tokenizer):
        made.append(tokenizer)
        learn(self, tokenizer)

    class Task:
        partition = 0

        def get():
            Task.partition += 1
            return Task

        def partitionId():
            return Task.partition

    monkeypatch.setattr(packing.WordTable, "__init__", counted)
    monkeypatch.setattr(packing, "TaskContext", Task)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two", None]})
    tasks = [list(packing._packed(iter([batch]), word_tokenizer(), 1, 2048, 64)) for _ in range(5)]
    assert [sum(b.num_rows for b in task) for task in tasks] == [2] * 5
    assert len(made) <= 1


def test_a_tokenizer_that_keeps_white_space_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="independently"):
        packing.WordTable(public_tokenizers.path("byte_bpe_50k.json"))


# Registered queries


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_source_divergence"])
def test_query_equals_sql(spark, name):
    rows, problem = check_oracle.compare(spark, check_oracle.connect(SF_DIR), name, SF_DIR)
    assert problem is None and rows > 0


@pytest.mark.parametrize("name, seed", [("op11_merkle_manifest", 1), ("op12_source_divergence", 2)])
def test_query_equals_sql_on_awkward_rows(spark, tmp_path, name, seed):
    rows = awkward(seed, MANY) if name.startswith("op11") else words_of(seed, 200)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.sql(ORACLE_SQL[name])
    assert check_oracle.canonical(found.columns, [tuple(r) for r in found.collect()]) == (
        check_oracle.canonical(expected.columns, expected.fetchall())
    )


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    expected = ids_of([(r.doc_id, None, None, None, r.text) for r in docs])
    by_doc = collections.defaultdict(list)
    for r in QUERIES["op13_packing"](spark, SF_DIR).collect():
        by_doc[r.doc_id].append(r)
    assert by_doc.keys() == expected.keys()
    for doc_id, (ids,) in expected.items():
        for r in by_doc[doc_id]:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids)
        assert sum(r.length for r in by_doc[doc_id]) == len(ids)
