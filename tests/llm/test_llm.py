"""Each text operator on edge rows and against its brute-force version."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute_jaccard
import brute_leaks
import brute_lines
import brute_lm
import brute_secrets
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import bpe, common, decontaminate, jaccard_join, jaccard_sql, line_dedup, lm_scoring, pieces, quality_rules, secret_scan, token_files, warc, words
from shelfspark.llm.elias_fano import EliasFano

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

#: Columns whose names an operator might use itself.
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, node long, key string, __t string, line int, n int"


def make(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, True, 7, "k", "t", 1, 2) for d, t, s in rows], SCHEMA)


def corpus(n=60, seed=3):
    """Documents with exact and near copies, ties, nulls, empty, blank, short and long texts."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeftné") for _ in range(r.randint(1, 7))) for _ in range(400)]
    text = lambda k: " ".join(r.choice(vocab) + r.choice(["", "", "", ",", "\n"]) for _ in range(k))
    rows = [(i, text(r.choice([3, 20, 60, 90])), f"s{i % 3}") for i in range(n)]
    for i in range(n, n + 25):
        t = rows[r.randrange(n)][1].split(" ")
        if i % 2 and len(t) > 20:
            t[r.randrange(len(t))] = "edited"
        rows.append((i, " ".join(t), "s0"))
    rows += [(200, None, None), (201, "", "s1"), (202, " \n\t ", "s1"), (203, text(6000), "s2"), (None, rows[5][1], None), (None, "a null id", "s1")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_repr(xs):
    return sorted(xs, key=repr)


def test_secrets(spark):
    texts = ["password = 'hunter22x' token: ab", "AKIA" + "A" * 16 + " AKIASHORT", "0123456789abcdef01234567", "key é🎉 API_KEY=\"x.y.z.z-1\"", "token:token:abcdefg", None, ""]
    texts += ["Zx9" + "aB3dE7gH1jK5mN8pQ2rS6tU4" + "==", "123e4567-e89b-12d3-a456-426614174000", "aQ1bW2cE3dR4fT5gY6hU7jI8example", "x" * 50, "deadbeefDEADBEEF0123456789ab"]
    rows = list(enumerate(texts))
    df = make(spark, [(i, t, "s") for i, t in rows])
    from pyspark.sql import functions as F

    found = secret_scan.find_secrets(df, "doc_id")
    got = {r["doc_id"]: ",".join(f"{secret_scan.KINDS[x['kind']]}:{x['start']}:{x['end']}" for x in r["spans"]) for r in found.collect()}
    assert got == {i: brute_secrets.row(i, t)[5] for i, t in rows}
    assert secret_scan.find_secrets(empty(spark), "doc_id").count() == 0
    assert "Python" not in found.select(F.size("spans"))._jdf.queryExecution().toString()


def test_secret_query(spark, tmp_path):
    """All contract columns of the query, with repeated rows and a null number."""
    texts = ["PassWord: 'aaaaaa' secret==b apikey=12345 api_key=123456", "tokentoken=abcdefg\n" * 3, None, "", "é" * 9 + "AKIA" + "Z" * 30]
    texts += ["f" * 23 + " " + "f" * 24 + "g" + "0" * 40, "secret\" = \"abcdef.g\" Ｔoken=abcdefgh", "ſecret=abcdefgh", "x " * 9000 + "token=" + "a1" * 20]
    rows = [*enumerate(texts), (None, texts[0]), (0, texts[0])]
    make(spark, [(d, t, "s") for d, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    got = secret_scan.op1_secret_scan(spark, str(tmp_path))
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert by_repr(map(tuple, got.select(*names).collect())) == by_repr(brute_secrets.row(d, t) for d, t in rows)


def test_secrets_in_long_candidates(spark):
    """Slugs, paths and letters of a megabyte, and a long random run with many spans."""
    r = random.Random(1)
    texts = ["a-1-" * 250_000 + "!", "ab/12/" * 170_000, "x" * 1_000_000, "-" + "a-1-" * 40, "a-1-" * 5_000 + "12345-b", "word_" * 9 + "7"]
    texts += ["".join(r.choice("ABCDEabcdefgh01234+/XYZ") for _ in range(30_000)), "token=" + "a1B2" * 250_000]
    found = secret_scan.find_secrets(make(spark, [(i, t, "s") for i, t in enumerate(texts[:-1])]), "doc_id")
    got = {x["doc_id"]: ",".join(f"{secret_scan.KINDS[y['kind']]}:{y['start']}:{y['end']}" for y in x["spans"]) for x in found.collect()}
    assert got == {i: brute_secrets.row(i, t)[5] for i, t in enumerate(texts[:-1])}
    assert got[6].count("entropy") > secret_scan.PAGE
    assert secret_scan.find_secrets(make(spark, [(0, texts[-1], "s")]), "doc_id").first()["spans"][0]["end"] == len(texts[-1])


@given(st.lists(st.text(alphabet="aB3/ =:token\"", max_size=60), max_size=4))
@settings(max_examples=10, deadline=None)
def test_secret_base_property(spark, texts):
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    got = {r["doc_id"]: len(r["spans"]) for r in secret_scan.find_secrets(make(spark, rows), "doc_id").collect()}
    assert got == {i: brute_secrets.row(i, t)[5].count(":") // 2 for i, t, _ in rows}


def test_jaccard(spark, docs, rows):
    got = jaccard_join.jaccard_groups(docs).select("doc_id", "n_shingles", "component_id")
    assert by_repr(map(tuple, got.collect())) == by_repr(brute_jaccard.groups([(d, t) for d, t, _ in rows]))
    assert jaccard_join.jaccard_groups(empty(spark)).count() == 0
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    gone = {d for d, _, c in brute_jaccard.groups([(d, t) for d, t, _ in rows]) if d is not None and c != d}
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _, _ in rows} - gone


def test_jaccard_sql(spark, rows):
    """The query's SQL on the same rows, without those that have no number."""
    import duckdb

    con, numbered = duckdb.connect(), [(d, t) for d, t, _ in rows if d is not None]
    con.register("documents", pa.table({"doc_id": pa.array([d for d, _ in numbered], pa.int64()), "text": pa.array([t for _, t in numbered], pa.string())}))
    assert by_repr(con.execute(jaccard_sql.ORACLE_SQL).fetchall()) == by_repr(brute_jaccard.groups(numbered))


def test_jaccard_hub_group(spark):
    """Copies that are only linked through one text, and some that are linked to none."""
    r = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base), "s")]
    for i in range(1, 120):
        w = list(base)
        for j in range(r.randint(0, 9)):
            w[r.randrange(150)] = f"x{i}_{j}"
        rows.append((i, " ".join(w), "s"))
    got = jaccard_join.jaccard_groups(make(spark, rows)).select("doc_id", "n_shingles", "component_id")
    assert by_repr(map(tuple, got.collect())) == by_repr(brute_jaccard.groups([(d, t) for d, t, _ in rows]))


def test_lines(spark, docs, rows):
    plain = [(d, t) for d, t, _ in rows if d is not None]
    df = make(spark, [(d, t, "s") for d, t in plain])
    want = brute_lines.dedup(plain)
    assert {r["doc_id"]: r["text"] for r in line_dedup.deduped(df).collect()} == want
    kept = line_dedup.drop_lines(docs)
    assert kept.columns == docs.columns and kept.count() <= docs.count()
    assert line_dedup.drop_lines(empty(spark)).count() == 0


@given(st.text(alphabet="abc", max_size=70), st.text(alphabet="abc", max_size=70))
@settings(max_examples=150, deadline=None)
def test_edit_distance(a, b):
    distance = brute_lines.plain_distance(a, b)
    assert line_dedup.edit_distance(a, b) == distance
    for share in (0.9, 0.6):
        most = int((1 - share) * max(len(a), len(b)) + 1e-9)
        assert line_dedup.alike([a, b, a], [b, a, a], share).tolist() == [distance <= most, distance <= most, True]


def test_bpe(spark, docs, rows):
    import tiktoken

    ref = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    digest = lambda b: hashlib.sha256(b).hexdigest()
    odd = [" a  b\n\n c  d\x1c e!\x1cf  ", "it's they'RE 're 'll\t\t x", "é" * 300 + " <|endoftext|> aaaa", "x" * 2000, " \x85 y\x85z　日本語 🎉🎉 ok", "\n", " "]
    extra = [(1000 + i, t, "s") for i, t in enumerate(odd)]
    df = docs.unionByName(make(spark, extra))
    want = []
    for d, t, _ in [*rows, *extra]:
        ids = ref.encode_ordinary(t or "")
        want.append((d, len(ids), digest(" ".join(map(str, ids)).encode()), digest((t or "").encode())))
    assert by_repr(map(tuple, bpe.encode_digests(df, RANKS, PATTERN).collect())) == by_repr(want)
    coded = bpe.encode_documents(df.where("doc_id is not null"), RANKS, PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.decode_documents(coded, RANKS, PATTERN).collect()}
    assert back == {d: t or "" for d, t, _ in [*rows, *extra] if d is not None}
    assert bpe.encode_digests(empty(spark), RANKS, PATTERN).count() == 0


def test_bpe_edits():
    import tiktoken

    encoder = bpe.PrefixEncoder(bpe.read_ranks(RANKS), PATTERN)
    ref = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})
    r = random.Random(2)
    some = lambda k: "".join(r.choice(" ab'sre\n.1é") for _ in range(k))
    for _ in range(60):
        text = some(30)
        live = bpe.Editable(encoder, text)
        for _ in range(4):
            i = r.randint(0, len(text))
            j, new = r.randint(i, min(len(text), i + 4)), some(r.randint(0, 5))
            text = text[:i] + new + text[j:]
            live.replace(i, j, new)
            assert live.ids() == ref.encode_ordinary(text)
        live.append(" more text")
        assert live.ids() == ref.encode_ordinary(text + " more text")


def test_leaks(spark):
    rows = corpus(40, 9)
    items = [(1, " ".join(rows[0][1].split()[:40])), (2, rows[1][1]), (3, "nothing of this stands anywhere in it all"), (4, None), (5, "")]
    docs = [(d, t) for d, t, _ in rows if d is not None]
    leaked = items[0][1].split()
    leaked[5:7] = ["para", "phrased"]
    docs.append((900, "before it all " + " ".join(leaked) + " and after"))
    df, bench = make(spark, [(d, t, "s") for d, t in docs]), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, bench).collect()}
    want = brute_leaks.leaks(docs, items)
    assert (900, 1) in got and len(got & want) >= 0.9 * len(want) and got <= want
    clean = decontaminate.drop_leaks(df, bench)
    assert clean.columns == df.columns and {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.find_leaks(empty(spark), bench).count() == 0
    assert decontaminate.find_leaks(df, bench.where("item_id = 4")).count() == 0


def test_leaks_by_length(spark):
    """Items copied, and with a quarter of their words replaced, inside other texts: nine in ten are found from 8 words on."""
    r = random.Random(11)
    vocab = ["".join(r.choice("bcdfghklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(3000)]
    word = lambda: vocab[int(len(vocab) * r.random() ** 3)]
    texts = [[word() for _ in range(300)] for _ in range(150)]
    items, docs, kinds = [], list(enumerate(" ".join(t) for t in texts)), {}
    for n in (6, 8, 10, 15, 25, 40):
        for changed in (0, n // 4):
            for _ in range(20):
                k, own, host = len(kinds), r.choice(texts), list(r.choice(texts))
                at = r.randrange(300 - n)
                item = own[at : at + n]
                copy = list(item)
                for i in r.sample(range(n - max(1, n // 3)), changed):
                    copy[i] = word()
                host[(place := r.randrange(300)) : place] = copy
                items.append((k, " ".join(item)))
                docs.append((1000 + k, " ".join(host)))
                kinds[k] = (n, changed)
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(make(spark, [(d, t, "s") for d, t in docs]), spark.createDataFrame(items, "item_id long, text string")).collect()}
    found = {}
    for k, kind in kinds.items():
        found[kind] = found.get(kind, 0) + ((1000 + k, k) in got)
    assert min(v for (n, _), v in found.items() if n >= 8) >= 18 and min(found.values()) >= 16, found


def test_basis_spans_the_rows(spark):
    rng = np.random.default_rng(0)
    a = rng.standard_normal((30, 5)) @ rng.standard_normal((5, 40))
    rows = spark.createDataFrame([(list(range(40)), [float(x) for x in r]) for r in a], "place array<int>, value array<float>")
    basis = decontaminate.randomised_basis(rows, 40, 5)
    assert basis.shape == (40, 5) and np.allclose(a @ basis @ basis.T, a, atol=1e-4)


def test_quality(spark, docs, rows):
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect() if r["doc_id"] is not None}
    assert got[200]["n_words"] == 0 and got[200]["base_failed"] and not got[202]["kept"]
    for d, t, _ in rows:
        if d is None:
            continue
        w = brute_lm.re.findall("[^\x20\x09-\x0d]+", t or "")
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)} if len(w) < 2000 else None
        assert got[d]["n_words"] == len(w) and (hit is None or got[d]["n_repeat_words"] == len(hit))
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert quality_rules.quality_rules(empty(spark)).count() == 0


def test_bad_host_goes(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, "too short", "bad") for i in range(60)] + [(100, good, "bad")] + [(200 + i, good, f"h{i % 5}") for i in range(100)] + [(400, good, None)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(make(spark, rows)).collect()}
    assert not got[100] and got[200] and got[400]


@pytest.mark.parametrize("broadcast_bits", [0, lm_scoring.BROADCAST_BITS])
def test_lm(spark, docs, rows, broadcast_bits):
    plain = [(d, t) for d, t, _ in rows]
    want, model = brute_lm.base(plain), brute_lm.scores(plain, lm_scoring.MIX)
    out = lm_scoring.score_documents(docs, broadcast_bits).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["doc_id"] is not None:
            w = want[r["doc_id"]]
            assert tuple(r[1:5]) == w[:4] and r["base_score"] == pytest.approx(w[4])
            # False hits of the filter only raise counts, at under one in a hundred probes.
            assert r["score"] == pytest.approx(model[r["doc_id"]], rel=0.03, abs=0.5)
    assert lm_scoring.score_documents(empty(spark), broadcast_bits).count() == 0


def test_lm_ways_agree(spark, docs):
    both = [{(r["doc_id"], r["score"]) for r in lm_scoring.score_documents(docs.where("doc_id < 80"), b).collect()} for b in (0, lm_scoring.BROADCAST_BITS)]
    assert both[0] == both[1]


def test_packed_counts():
    x = np.array([0, 1, 254, 255, 256, 1 << 40])
    assert lm_scoring.unpack_counts(lm_scoring.pack_counts(x), len(x)).tolist() == x.tolist()


def test_log_bloom_levels():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 32, 4000, dtype=np.uint64).astype(np.uint32))
    counts = rng.integers(1, 300, len(keys))
    model = lm_scoring.LogBloom([lm_scoring.segment_bits(keys, counts)])
    level = model.levels(keys.astype(np.uint64) << np.uint64(32))
    want = np.floor(np.log2(counts)) + 1
    assert (level >= want).all() and (level == want).mean() > 0.98


def test_token_files(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    plain = sorted((d, x or "") for d, x, _ in rows if d is not None)
    df = make(spark, [(d, x, "s") for d, x in plain])
    folder = f"file://{tmp_path}/tok"
    got = by_repr(map(tuple, token_files.read_tokens(spark, folder, token_files.write_tokens(df, folder, path)).collect()))
    want, at = [], 0
    for d, x in plain:
        ids = [*t.encode(x, add_special_tokens=False).ids, 0]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == by_repr(want)
    one = token_files.TokenFile(token_files.pack([None, 3, 3, 9], [np.array([1, 2]), np.array([5]), np.zeros(0), np.array([7])], 4))
    with pytest.raises(ValueError):
        token_files.pack([1], [np.array([70_000])], 2)
    assert token_files.TokenFile(token_files.pack([1], [np.array([70_000])], 4)).ids(0, 1).tolist() == [70_000]
    assert one.doc_ids() == [None, 3, 3, 9] and [one.span(k) for k in range(4)] == [(0, 2), (2, 3), (3, 3), (3, 4)] and one.ids(2, 3).tolist() == [5]


@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "a", " ", "<|endof", "text|>", "é", "\n", "12", "<|", "|>"]), max_size=9), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_added_tokens_as_the_library_does(texts):
    """Ids of texts that hold an added token: at the start, inside a word, twice in a row, cut off."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["".join(t) for t in texts] + ["<|endoftext|>", "a<|endoftext|>b", "<|endoftext|><|endoftext|> x", "plain words", ""]
    got = token_files.encode_texts(path, pa.array(texts, pa.string()))
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=600))
@settings(max_examples=40, deadline=None)
def test_elias_fano(numbers):
    x = sorted(numbers)
    f, _ = EliasFano.from_buffer(memoryview(EliasFano.build(np.array(x)).to_bytes()))
    assert f.all().tolist() == x and [f.select(i) for i in range(len(x))] == x


def test_warc(spark, tmp_path):
    page = "<html>" + "x" * 200
    rows = [(5, "u5", page), (2, "u2\r\nX: y", page), (9, "u9", page), (3, "u3", "short"), (4, "u4", "short"), (6, None, None), (2, "again", page), (None, "n", page)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, refers_to int")
    folder = f"file://{tmp_path}/warc"
    warc.write_archives(df, folder)
    got = by_repr((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_archives(spark, folder).collect())
    n = len(page)
    want = [(2, "response", None, n), (2, "response", None, n), (5, "revisit", 2, n), (9, "revisit", 2, n), (3, "response", None, 5), (4, "response", None, 5), (6, "response", None, 0), (None, "revisit", 2, n)]
    assert got == by_repr(want)


def test_pieces_table_is_bounded():
    table = pieces.PieceTable(lambda new: [[len(x)] for x in new], most=3)
    assert [x.tolist() for x in table(pa.array(["a bb", "", "  c"]))] == [[1, 3], [0], [3]]
    for i in range(20):
        table(pa.array([f"w{i} v{i}"]))
    assert len(table.index) <= 8


def test_word_hash_is_by_content():
    a = words.hash_strings(pa.array(["abc", "abcdefghijk", "", "abc", "abcdefghijl"]).slice(0))
    assert a[0] == a[3] and len(set(a.tolist())) == 4
    assert (words.hash_strings(pa.array(["zz", "abc", "q"]).slice(1, 1)) == a[:1]).all()


def test_pipeline_columns(spark, tmp_path):
    import corpus_pipeline

    rows = [(d, t, "en", s, len(t or "")) for d, t, s in corpus(30, 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, df = df, common.saved(stage(spark, df, str(tmp_path)), name)
        assert df.columns == before.columns and df.count() <= before.count()
    out = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path))
    assert out.count() == df.count() and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_workers_keep_one_operators_tables():
    """A worker that goes on to lines drops the tables of byte-level BPE; else both stay in an executor's memory."""
    common.worker_tables("bpe")["ranks"] = [1]
    assert common.worker_tables("bpe") == {"ranks": [1]}
    assert list(line_dedup._describe(iter([]))) == []
    assert common.worker_tables("lines") == {} and common.worker_tables("bpe") == {}


def test_letters_of_one_table_are_bounded(monkeypatch):
    """One long line among very many short ones does not widen the rows of all."""
    seen, within = [], line_dedup._within

    def noted(xs, ys, most):
        seen.append(len(xs) * max(map(len, xs)))
        return within(xs, ys, most)

    monkeypatch.setattr(line_dedup, "_within", noted)
    xs, ys = ["ab cd efghijklmnopq"] * 1100 + ["b" + "x" * 4900 + "c"], ["bcdefghijklmnopqrst"] * 1100 + ["x y" + "x" * 4897 + "dd"]
    assert line_dedup.alike(xs, ys).tolist() == [False] * 1100 + [True]
    assert seen and max(seen) <= line_dedup.LETTERS


def test_lines_with_a_changed_letter_meet(spark):
    """At least 0.9 of lines of every length and their copies with one other letter are one group."""
    r = random.Random(11)
    vocab = ["".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randint(1, 9))) for _ in range(2000)]
    rows, kinds = [], [(4, 7), (8, 15), (16, 30), (31, 60), (61, 120)]
    for k, (low, high) in enumerate(kinds):
        for i in range(60):
            line = "start" + " ".join(r.choice(vocab) for _ in range(r.randint(low, high)))
            at = r.choice([x for x, c in enumerate(line) if c != " "])
            rows += [(1000 * k + 2 * i, line, "s"), (1000 * k + 2 * i + 1, line[:at] + "z" + line[at + 1 :], "s")]
    got = {d["doc_id"]: d["n_dropped"] for d in line_dedup.deduped(make(spark, rows)).collect()}
    for k in range(len(kinds)):
        assert sum(got[1000 * k + 2 * i + 1] for i in range(60)) >= 54
    assert not any(n for d, n in got.items() if d % 2 == 0)


def test_leaks_of_a_large_benchmark(spark):
    """Exact copies are found whatever the number of passages."""
    r = random.Random(4)
    vocab = [f"{r.choice('abcdefgh')}{i}" for i in range(6000)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(25))) for i in range(1300)]
    df = make(spark, [(i, t, "s") for i, t in items[::10]])
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(i, i) for i, _ in items[::10]}


def test_rank_is_below_the_passages():
    """Passages that repeat each other need fewer directions, and keep the share of their weight that is stated."""
    r = np.random.default_rng(3)
    base = [[f"w{x}" for x in r.integers(0, 300, 30)] for _ in range(12)]
    items = [(10 * k + i, [w if r.random() > 0.1 else f"x{k}{i}" for w in ws]) for k, ws in enumerate(base) for i in range(5)]
    space = decontaminate.Space(items, np.ones(decontaminate.PLACES, np.float32))
    full = np.zeros((len(space.passages), len(space.vocabulary)))
    for row, (p, v) in zip(full, space.rows(), strict=True):
        row[p] = v
    space.keep(np.linalg.svd(full, full_matrices=False)[2].T)
    assert space.basis.shape[1] < 0.6 * len(space.passages)
    assert ((full @ space.basis) ** 2).sum(axis=1).min() >= decontaminate.ENERGY - 1e-4


NAMES = ["gone", "__gone", "row", "n", "__key", "__text", "__l", "filled", "doc", "key", "node", "line", "cut", "block", "train", "root", "a", "b", "bad"]


@pytest.mark.parametrize("stage", ["quality", "lines", "jaccard", "leaks"])
def test_stages_keep_columns_of_any_name(spark, stage):
    from pyspark.sql import functions as F

    r = random.Random(8)
    text = lambda: " ".join(f"w{r.randrange(900)}" for _ in range(40))
    rows = [(i, text(), "s") for i in range(12)]
    rows += [(20, rows[0][1], "s"), (21, rows[1][1] + "\nown line of this one", "s"), (None, rows[2][1], None), (22, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in NAMES})
    bench = spark.createDataFrame([(1, rows[3][1])], "item_id long, text string")
    run = {"quality": quality_rules.keep_good, "lines": line_dedup.drop_lines, "jaccard": jaccard_join.keep_first, "leaks": lambda d: decontaminate.drop_leaks(d, bench)}[stage]
    plain = {(x["doc_id"], x["text"]) for x in run(df.select("doc_id", "text", "source")).collect()}
    out = run(df)
    assert out.columns == df.columns
    got = out.collect()
    assert {(x["doc_id"], x["text"]) for x in got} == plain and len(plain) < len(rows)
    assert all(x[c] == (None if x["doc_id"] is None else f"{c}{x['doc_id']}") for x in got for c in NAMES)
