"""The corpus operators on small tables: brute force, round trips and the stated edge cases."""

import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
from pyspark.sql import functions as F

from demandloom.llm import (
    exact_dedup,
    jaccard_join,
    key_counts,
    language,
    line_dedup,
    lm_score,
    mixing,
    packing,
    quality_rules,
    quality_votes,
    token_blocks,
    tokens,
)
from demandloom.llm.catalog import ORACLES, QUERIES
from demandloom.llm.store import new_path
from tests.compare import differences

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, block int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = tokens.default_tokenizer()


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abdeiklmnorstu") for _ in range(pick.randint(2, 7))) for _ in range(words))


def edge_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text."""
    long = prose(1, 30_000)
    texts = [
        None, "", " \t\n ", "One", "one two", "The cat sat. " * 20, "The  cat\nsat. " * 20, long, long + " more",
        prose(2, 300), prose(2, 300) + " tail", prose(3, 120), prose(3, 120), "Ünï çødé ß あ <|endoftext|> Á",
    ]
    rows = [(i, t, ("en", None)[i % 2], ("a", "b", None)[i % 3], None if t is None else len(t), "x", None, i) for i, t in enumerate(texts)]
    return [*rows, rows[9], (None, prose(4, 80), None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, folder, name):
    assert differences(spark, duck, QUERIES[name], ORACLES[name], folder) == ""


def test_empty_tables_give_no_rows(empty):
    held = empty.select("doc_id", "text", F.lit(False).alias("held_out"))
    assert exact_dedup.dedup_documents(empty).count() == 0
    assert quality_rules.judged(empty).count() == 0
    assert line_dedup.drop_lines(empty).count() == 0
    assert mixing.mixed(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert lm_score.score_documents(held).count() == 0
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert language.predict(empty, language.fit(empty)).count() == 0
    assert quality_votes.score_documents(empty, None).count() == 0


def test_exact_dedup_on_edges(spark, edge):
    rows = exact_dedup.dedup_documents(edge).collect()
    assert len(rows) == 16
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["keep_id"] == 0 and not by[1]["kept"] and by[0]["group_size"] == 2
    assert by[6]["keep_id"] == 5 and by[12]["keep_id"] == 11
    assert sorted(r["kept"] for r in rows if r["doc_id"] == 9) == [False, True]
    assert sum(r["kept"] for r in rows) == len({r["digest"] for r in rows})
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("digest_index_")]


def test_digest_index_counts_over_three_batches(spark, edge):
    index = exact_dedup.DigestIndex(spark, "dedup_batches", 3, new_path(spark, "index"))
    first = index.add(edge.where("doc_id < 6"), "a").collect()
    assert sum(r["kept"] for r in first) == 5
    later = {r["doc_id"]: r for r in index.add(edge.where("doc_id = 6 or doc_id = 11"), "b").collect()}
    assert later[6]["keep_id"] == 5 and not later[6]["kept"] and later[6]["group_size"] == 2
    assert later[11]["kept"]
    copies = edge.where("doc_id = 6").withColumn("doc_id", F.lit(50).cast("long"))
    (third,) = index.add(copies, "c").collect()
    assert (third["keep_id"], third["group_size"], third["kept"]) == (5, 3, False)
    plan = index.texts()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    index.drop()


def test_digest_index_outlives_its_session_and_takes_a_batch_again(spark, edge):
    path = new_path(spark, "kept-index")
    index = exact_dedup.DigestIndex(spark, "before_restart", 3, path)
    index.add(edge.where("doc_id in (5, 8)"), "monday").count()
    spark.sql("DROP TABLE before_restart")  # the catalog forgets the table, as a new session does; the files stay

    index = exact_dedup.DigestIndex(spark, "after_restart", 3, path)
    batch = edge.where("doc_id in (6, 11, 12)")
    once = {r["doc_id"]: r["kept"] for r in index.add(batch, "tuesday").collect()}
    assert once == {6: False, 11: True, 12: False}
    again = {r["doc_id"]: r["kept"] for r in index.add(batch, "tuesday").collect()}
    assert again == once
    size = {r["doc_id"]: r["group_size"] for r in index.add(batch, "tuesday").collect()}
    assert size == {6: 2, 11: 2, 12: 2}
    assert index.rows().where("first").count() == 3
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, "other_buckets", 5, path).add(batch, "wednesday")
    assert not spark.catalog.tableExists("other_buckets")
    index.drop()


def test_numerics_that_are_no_letters_name_no_language():
    for text in ("\u00bd", "\u00b2 \u2460", "3\u00be", "\u2167 12 _", None, " "):
        assert language.letters(text) == b""
    assert language.letters("1\u00bd Tassen, \u00c4pfel \u65e5\u672c") == "tassen \u00e4pfel \u65e5\u672c".encode()


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def test_quality_rules_count_like_brute_force(spark, edge, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(edge.columns[:5]).where("doc_id < 300")
    rows = docs.unionByName(edge.select(docs.columns))
    for r in quality_rules.judged(rows).collect():
        got = tuple(r[c] for c in [*quality_rules.BASE, "base_failed"])
        assert got == base_counts(r["row"]["text"])
        assert not (r["base_failed"] and r["kept"])
    assert set(quality_rules.keep_good(edge).columns) == set(edge.columns)


def test_quality_rules_keep_labelled_good_documents(spark, folder):
    rows = QUERIES["op6_quality_rules"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    met = rows.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    rate = dict(map(tuple, met))
    assert rate[1] > 0.98 and rate[0] < 0.2


def test_lines_of_many_pages_are_dropped(spark):
    rows = [(i, f"banner\nown line {i}\n", "s") for i in range(9)] + [(9, None, "s"), (10, "banner", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(docs, 0.5, 3).collect()}
    assert got[3] == "own line 3\n" and got[9] is None and got[10] == "banner"


def kept_by_hand(rows, ratio, least, edge_ratio):
    """Texts after both line rules, from ``(doc_id, text, source, lang)``."""
    bare = {r[0]: [x.strip(" \t\r\x0b\x0c") for x in r[1].split("\n")] for r in rows}
    inside, ends, sizes = defaultdict(set), defaultdict(set), Counter()
    for i, _, source, lang in rows:
        sizes["s", source] += 1
        sizes["l", lang] += 1
        shown = [x for x in bare[i] if x]
        for x in shown:
            inside["s", source, x].add(i)
        for x in shown[:2] + shown[-2:]:
            ends["l", lang, x].add(max((len(y), zlib.crc32(y.encode())) for y in shown))
    gone = {k for k, v in inside.items() if len(v) >= least and len(v) > ratio * sizes[k[:2]]}
    gone |= {k for k, v in ends.items() if len(v) >= least and len(v) > edge_ratio * sizes[k[:2]]}
    return {
        i: "\n".join(x for x, b in zip(text.split("\n"), bare[i]) if ("s", source, b) not in gone and ("l", lang, b) not in gone)
        for i, text, source, lang in rows
    }


def test_headers_of_a_language_go_and_copies_and_prose_stay(spark):
    rows = []
    for i in range(900):
        body = [prose(10_000 + 9 * i + j, 12) for j in range(6)]
        if i % 20 == 3:  # 5% of the documents, 0.25% to 5% of a source: a header of two lines, one of them padded
            body = ["Share this page ", "Menu", *body]
        if i % 25 == 4:
            body = [*body, "All rights reserved."]
        if i % 12 == 5:  # a sentence of prose, never at the ends
            body.insert(4, "And so on.")
        if i >= 860:  # copies of one document
            body = [prose(j, 12 + j) for j in range(6)]
        rows.append((i, "\n".join(body), f"s{i % 20}", "en" if i % 3 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(docs, 0.9, 4, 0.01).collect()}
    assert got == kept_by_hand(rows, 0.9, 4, 0.01)
    whole = "\n".join(got.values())
    assert "Share this page" not in whole and "Menu" not in whole and "rights reserved" not in whole
    assert "And so on." in whole and all(got[i] == rows[i][1] for i in range(860, 900))


def test_mixing_repeats_and_targets(spark, edge):
    rows = [(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.taken(docs).collect()
    by = defaultdict(float)
    for r in taken:
        times = r["passes"] + (r["shard"] is not None)
        assert 0 <= times <= 3
        by[r["row"]["source"], r["target"]] += r["size"] * times
    for (_, target), words in by.items():
        assert abs(words - target) < 0.02 * target
    copies = mixing.mixed(docs).groupBy("doc_id").count().collect()
    want = {r["row"]["doc_id"]: r["passes"] + (r["shard"] is not None) for r in taken}
    assert {r["doc_id"]: r["count"] for r in copies} == {k: v for k, v in want.items() if v}
    assert set(mixing.mixed(edge).columns) == set(edge.columns)


def test_encoder_equals_the_library_on_whole_texts(spark, folder):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENIZER)
    texts = [r[1] for r in edge_rows()] + ["<|STARTOFTEXT|> İ don't 12 <|startoftext|>x", "a b c É́"]
    texts += [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").limit(200).collect()]
    ids, offsets = tokens.encode(pa.array(texts), TOKENIZER)
    for text, a, b in zip(texts, offsets, offsets[1:]):
        assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_chunks_with_special_tokens_and_marks_encode_as_alone():
    path = tokens.default_tokenizer()
    chunks = ["a", "<|endoftext|>", "x<", "|>y", "<|", "e\u0301", "\u0301", "q\x1cq", "'s", "\u0130I"] * 30
    alone = [tokens._tokenizer(path).encode(c, add_special_tokens=False).ids for c in chunks]
    plain = [(c, ids) for c, ids in zip(chunks, alone) if "<|" not in c]
    for some in (list(zip(chunks, alone)), plain):
        found = tokens.encode_chunks([c for c, _ in some], path)
        assert [list(np.frombuffer(f, np.uint32)) for f in found] == [ids for _, ids in some]


def chunk_mix(number: int) -> list[str]:
    """Distinct chunks: plain ones, and some that need the tokenizer's normalising or its patterns."""
    pick = random.Random(number)
    odd = ["'s", "a's", "x'd", "<|endoftext|>", "<|", "x<", "|>y", "\u00c9t\u00e9", "e\u0301", "\u0301", "\u00aa1\u00bd",
           "\u65e5\u672c", "a\x1cb", "\u00a0x", "\u00d7\u00f7", "\x00", "a\x85b", "\u0130i", "\u00b5m", "`~^_"]
    plain = {"".join(pick.choices("aeinrst\u00e9\u00fc\u00df\u00ff1234567890.,!$%&*#-()[]{}|<>\"", k=pick.randint(1, 12))) for _ in range(number)}
    return sorted(odd) + sorted(plain - set(odd))


def test_distinct_chunks_encode_as_by_the_whole_tokenizer():
    chunks = chunk_mix(3000)
    ids, lengths = tokens.encode_distinct(pa.array(chunks), TOKENIZER)
    whole = tokens._tokenizer(TOKENIZER)
    ends = np.cumsum(lengths)
    for chunk, a, b in zip(chunks, ends - lengths, ends):
        assert ids[a:b].tolist() == whole.encode(chunk, add_special_tokens=False).ids, chunk
    assert [len(x) for x in tokens.encode_distinct(pa.array([], pa.string()), TOKENIZER)] == [0, 0]


def test_plain_chunks_need_no_patterns_and_little_memory(monkeypatch):
    monkeypatch.setattr(tokens, "_SEEN", {})
    given = []
    pattern_path = tokens.encode_chunks
    monkeypatch.setattr(tokens, "encode_chunks", lambda c, path: given.extend(c) or pattern_path(c, path))
    words = [f"{a}{b}{c}{d}{e}{s}" for a in "bdfgkl" for b in "aeiou" for c in "mnprst" for d in "aeiou" for e in "dklnrst" for s in ("", ",", ".", "a", "en")]
    texts = pa.array([" ".join(words), "don't"])
    tokens.encode(texts.slice(1), TOKENIZER)
    tokens.encode(pa.array(["warm up"]), TOKENIZER)
    tracemalloc.start()
    try:
        tokens.encode(texts, TOKENIZER)
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert given == ["don't"]
    assert held < 120 * len(words)


def test_forgotten_chunks_encode_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "_SEEN", {})
    monkeypatch.setattr(tokens, "REMEMBERED", 300)
    whole = tokens._tokenizer(TOKENIZER)
    pick = random.Random(5)
    rare = chunk_mix(400)
    often = ["again", "and", "again,"]
    for _ in range(12):
        texts = [" ".join([*often, *pick.choices(rare, k=40)]) for _ in range(2)]
        ids, offsets = tokens.encode(pa.array(texts), TOKENIZER)
        for text, a, b in zip(texts, offsets, offsets[1:]):
            assert ids[a:b].tolist() == whole.encode(text, add_special_tokens=False).ids
    (kept,) = tokens._SEEN.values()
    kept._forget()
    assert set(often) <= set(kept.names.to_pylist())


def test_packing_places_every_piece(edge):
    pieces = packing.cut(edge, TOKENIZER, with_ids=True).collect()
    spark = edge.sparkSession
    table = spark.createDataFrame(pieces, packing._PIECES + ", ids binary")
    packed = packing.pack(table).cache()
    bins = defaultdict(list)
    for r in packed.collect():
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    total = sum(p["length"] for p in pieces)
    assert sum(n for b in bins.values() for _, n in b) == total
    assert len(bins) <= -(-total // packing.CAPACITY) + 2
    whole = packing.sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole)


@pytest.mark.parametrize("seed", range(5))
def test_plan_fills_sequences(seed):
    pick = random.Random(seed)
    lengths = [pick.choice([pick.randint(1, 100), pick.randint(34, 66), 50, 33]) for _ in range(500)]
    count = Counter(lengths)
    runs = sorted(map(tuple, packing.plan(count, 100)))
    used, fill = Counter(), Counter()
    seen = set()
    for at, (length, first, sequence, offset, per) in enumerate(runs):
        nxt = runs[at + 1][1] if at + 1 < len(runs) and runs[at + 1][0] == length else count[length]
        for r in range(nxt - first):
            place = (sequence + r // per, offset + r % per * length)
            cells = {(place[0], place[1] + i) for i in range(length)}
            assert not cells & seen and place[1] + length <= 100
            seen |= cells
            used[length] += 1
            fill[place[0]] += length
    assert used == count
    assert len(fill) <= 1.1 * sum(lengths) / 100 + 1


@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 2**32])
def test_blocks_round_trip(top):
    random_ = np.random.default_rng(top % 1000)
    for size in (0, 1, 127, 128, 129, 5000):
        ids = random_.integers(0, top, size, dtype=np.uint64)
        ids[random_.random(size) < 0.05] = top - 1
        starts, payload = token_blocks.pack_ids(ids)
        assert np.array_equal(token_blocks.unpack_ids(starts, payload, size), ids.astype(np.uint32))
        if len(starts) > 1:
            tail = token_blocks.unpack_ids(starts[1:], payload, size - 128)
            assert np.array_equal(tail, ids[128:].astype(np.uint32))


def test_token_files_read_back(spark, edge):
    folder = new_path(spark, "tokens")
    token_blocks.write_tokens(edge, folder, TOKENIZER)
    rows = token_blocks.read_tokens(spark, folder, with_ids=True).orderBy("start").collect()
    assert len(rows) == 16
    end = 0
    for r in rows:
        assert r["start"] == end and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        end += r["n_tokens"]
    names = [r["doc_id"] for r in rows]
    assert names[-1] is None and names[:-1] == sorted(names[:-1])


def test_ppm_probabilities_add_up_and_match_direct_coding():
    texts = [b"abracadabra", b"cadabra abba", b"zzz"]
    keys, _ = language.grams(texts)
    grams, counts = np.unique(keys, return_counts=True)
    trees = language.ContextTrees(["x"], grams, counts[:, None].astype(float))
    for context in (b"abra", b"    ", b"qqqq", b"qbra", b"zzzz"):
        base = int.from_bytes(context, "big") << 8
        p = np.exp(trees.logp(base + np.arange(256))).sum()
        assert abs(p - 1) < 1e-9


def test_language_on_held_out_and_edges(spark, edge, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op1_language_id"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    learned = docs.where(language.remainder(F.col("doc_id"), 4) != 2)
    rows = language.predict(edge, language.fit(learned)).collect()
    assert len(rows) == 16
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in (0, 1, 2))
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_quality_votes_on_held_out_and_edges(spark, edge, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = QUERIES["op3_quality_votes"](spark, folder).join(labels, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.9
    voters = quality_votes.fit(labels, spark.read.parquet(f"{folder}/documents.parquet"))
    rows = quality_votes.score_documents(edge, voters).collect()
    assert len(rows) == 16 and all(0 <= r["score"] <= 1 for r in rows)


def test_bytes_and_parts_of_keys_round_trip():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**64, 1000, dtype=np.uint64))
    assert np.array_equal(key_counts.from_bytes(key_counts.to_bytes(keys)), keys)
    table = key_counts.sent(7, keys, np.ones(len(keys), np.int64), 13)
    back = [key_counts._sorted_numbers(k) for k in table.column("keys").to_pylist()]
    assert np.array_equal(np.concatenate(back), keys)


class Applied:
    """Stands for a DataFrame: gives the function that ``totals`` applies to a part."""

    def groupBy(self, key):
        return self

    def applyInArrow(self, function, schema):
        return function


def test_a_part_is_added_up_in_little_memory():
    random_ = np.random.default_rng(3)
    drop = np.uint64(7)
    shared = random_.integers(0, 2**56, 15_000, dtype=np.uint64) << drop
    runs, counts = [], []
    for _ in range(40):
        own = random_.integers(0, 2**56, 20_000, dtype=np.uint64) << drop
        runs.append(np.unique(np.concatenate([own, random_.choice(shared, 10_000)])))
        counts.append(random_.integers(0, 400, len(runs[-1])).astype(np.uint64))
    table = pa.concat_tables([key_counts.sent(i, k, c, 1, drop) for i, (k, c) in enumerate(zip(runs, counts))])
    different, place = np.unique(np.concatenate(runs), return_inverse=True)
    total = np.zeros(len(different), np.uint64)
    np.add.at(total, place, np.concatenate(counts))
    add = key_counts.totals(Applied(), lm_score.statistics, drop)
    tracemalloc.start()
    try:
        out = add(table)
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    rows = out.filter(pa.compute.greater_equal(out.column("block"), 0)).sort_by("block")
    for run, found in zip(runs, rows.column("counts").to_pylist()):
        assert np.array_equal(key_counts.from_bytes(found), total[np.searchsorted(different, run)])
    (stats,) = [x for x in out.column("stats").to_pylist() if x is not None]
    assert np.array_equal(stats, lm_score.statistics(different, total))
    assert peak < 5 * sum(r.nbytes for r in runs)


def test_lm_base_is_exact_and_arcs_add_up(spark, edge):
    docs = edge.select("doc_id", (F.coalesce("doc_id", F.lit(0)) == 11).alias("held_out"), "text")
    rows = lm_score.score_documents(docs).collect()
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    own = [(r["doc_id"], [*WORD.findall((r["text"] or "").translate(lower)), None], r["held_out"]) for r in docs.collect()]
    count = Counter(w for _, words, held in own if not held for w in words)
    n, v = sum(count.values()), len(count)
    want = sorted((len(w), sum(count[x] > 0 for x in w), round(sum(np.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for _, w, _ in own)
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["train_tokens"] == n and r["score"] < 0 for r in rows)


def test_automaton_is_a_distribution():
    words = np.array([5.0, 3, 1, 1])
    bins = lm_score.count_bin(words)
    stats = np.concatenate([np.bincount(bins, minlength=256), np.bincount(bins, weights=words, minlength=256), [2, 0, 6, 3, 1]])
    model = lm_score.Automaton(stats)
    unknown = model.root(np.array([0.0]))[0]
    assert abs(model.root(words).sum() + unknown - 1) < 1e-9
    fail = model.failure(np.array([5.0]))[0]
    pairs = np.array([2.0, 2, 1, 0])
    out = ((1 - fail) * pairs / 5 + fail * model.root(words)).sum() + fail * unknown
    assert abs(out - 1) < 1e-9


def brute_components(texts):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for d, t in texts.items():
        w = WORD.findall((t or "").translate(lower))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_jaccard_join_finds_every_link(spark):
    pick = random.Random(5)
    base = prose(9, 60).split()
    texts = {0: None, 1: " ", 2: "a b", 3: "A  b"}
    for n in range(4, 124):  # many near copies of one short text: frequent tokens, chains of links
        words = list(base)
        for _ in range(pick.randint(0, 3)):
            words[pick.randrange(len(words))] = f"x{pick.randint(0, 3)}"
        texts[n] = " ".join(words[: pick.choice([60, 60, 58, 30])])
    other = prose(10, 400).split()
    for n in range(124, 184):
        words = list(other)
        for _ in range(pick.randint(0, 12)):
            words[pick.randrange(400)] = f"y{pick.randint(0, 20)}"
        texts[n] = " ".join(words)
    for n in range(184, 200):
        texts[n] = prose(n, pick.randint(5, 40))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == brute_components(texts)


def test_jaccard_join_on_edges(edge):
    rows = jaccard_join.near_duplicates(edge).collect()
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert len(rows) == 16 and by[8] == 7 and by[10] == 9 and by[12] == 11 and by[0] == 0
    kept = jaccard_join.one_of_each(edge)
    assert kept.columns == edge.columns
    assert kept.where("doc_id in (8, 10, 12)").count() == 0 and kept.where("doc_id = 9").count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_share_a_signature(seed):
    pick = np.random.default_rng(seed)
    for size in (1, 3, 15, 16, 19, 20, 127, 130, 159, 400, 1300):
        one = np.unique(pick.integers(0, 2**63, size, dtype=np.uint64))
        df = dict(zip(one.tolist(), pick.choice([2, 20, 40, 500], len(one)).tolist()))
        drop = pick.permutation(len(one))[: len(one) // 5]
        other = np.delete(one, drop)
        if len(other) * 100 >= 80 * len(one):
            a, b = (jaccard_join.signatures(s, np.array([df[x] for x in s.tolist()])) for s in (one, other))
            assert len(np.intersect1d(a, b))


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(300)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder), name)
        assert docs.columns == columns and docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.agg(F.sum("length")).first()[0] > 0


def near_threshold_groups(copies: int, seed: int = 5):
    """Groups of edited copies whose similarities lie on both sides of 0.8, and one id under two texts."""
    pick, rows = random.Random(seed), []
    for group in range(3):
        words = prose(100 + group, 60).split()
        for _ in range(copies):
            mine = list(words)
            for at in pick.sample(range(60), pick.choice([0, 1, 1, 2, 2, 3])):
                mine[at] = "x" + str(pick.randrange(10**6))
            rows.append((len(rows), " ".join(mine)))
    base = prose(900, 40)
    other = prose(901, 40)
    return [*rows, (900, base), (900, other), (901, base + " tail"), (902, other + " tail")]


@pytest.mark.parametrize("copies", [20, 60])
def test_large_signatures_lose_no_link(spark, monkeypatch, copies):
    monkeypatch.setattr(jaccard_join, "FEW", 8)
    rows = near_threshold_groups(copies)
    sets = []
    for _, text in rows:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    least = defaultdict(lambda: 10**9)
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least[root(i)], doc_id)
    want = Counter((doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows))
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == want
    assert len(set(least.values())) > 3
