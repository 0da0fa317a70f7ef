"""Each corpus operator against a brute-force version or its library, and on awkward tables."""

import hashlib
import math
import re
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from growth_spark.llm import decontaminate, html_text, language, near_dedup, personal_data, quality, queries, sentencepiece_wfst, substring_dedup, suffix_dedup, token_counts

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = ["", " ", "a", "x" * 5000, "ab " * 400, "\n\n\t  \n", "naïve 😀 ² 日本語 ▁x", "a b　c", "1.2.3.4 +1 (407) 555-7710 a@b.co", "<|endoftext|>", "The end.\nThe end.\nThe end."]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, a null key, and columns whose names clash with the operators' own."""
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", len(t)) for i, t in enumerate(ODD)]
    rows += [(50, None, "en", "s", None), (51, "same text here for you all", "fr", "s", 1), (51, "same text here for you all", "fr", "s", 1), (None, "no key at all in this row", "en", None, 1)]
    extra = {c: F.lit(1) for c in ("doc", "bytes", "n", "s", "a", "g", "kind", "open", "spans", "sketch", "v", "hits", "items", "rate", "_text", "key", "text_sha256", "own", "root", "class", "mark", "_key", "p", "at", "node", "component", "_bucket")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(extra)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def test_token_counts_are_the_library_s(docs, texts, odd, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for df in (docs, odd):
        want = {r["doc_id"]: (len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in df.select("doc_id", "text").collect()}
        rows = token_counts.token_counts(df, path).collect()
        assert len(rows) == df.count()
        assert all((r["n_bytes"], r["n_tokens"]) == want[r["doc_id"]] and r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    assert token_counts.token_counts(empty, path).count() == 0


def test_encoding_and_decoding_are_the_library_s(docs, odd, empty):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (docs, odd):
        found = sentencepiece_wfst.encode(df, path)
        want = {r["doc_id"]: library.encode(r["text"] or "") for r in df.select("doc_id", "text").collect()}
        assert all(list(r["ids"]) == want[r["doc_id"]] for r in found.collect())
        assert all(r["text"] == library.decode(want[r["doc_id"]]) for r in sentencepiece_wfst.decode(found, path).collect())
        for r in sentencepiece_wfst.round_trip(df, path).collect():
            assert r["ids_sha256"] == hashlib.sha256(array("i", want[r["doc_id"]]).tobytes()).hexdigest() and r["n_ids"] == len(want[r["doc_id"]])
    assert sentencepiece_wfst.round_trip(empty, path).count() == 0


PIECES = ["▁", "a", "b", "c", "d", "e", "▁a", "▁b", "ab", "bc", "abc", "▁ab", "▁abc", "cd", "de", "cde", "abcd", "ss", "s", "1", "2", "12", "▁1", "fi", "f", "i", "é"]


def model_file(folder, kind, fallback, user, strip):
    """A small model (1 unigram, 2 BPE) whose normaliser is the library's own NFKC map."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    spec, proto = pb.ModelProto(), pb.ModelProto()
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    for piece, kind_ in [("<unk>", 2), ("<s>", 3), *([(f"<0x{b:02X}>", 6) for b in range(256)] if fallback else []), *((u, 4) for u in user)]:
        proto.pieces.add(piece=piece, score=0, type=kind_)
    scores = -np.random.default_rng(3).random(len(PIECES)) * 6 - 1 if kind == 1 else -np.arange(len(PIECES))
    for piece, score in zip(PIECES, scores, strict=True):
        proto.pieces.add(piece=piece, score=float(score), type=1)
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback, proto.trainer_spec.vocab_size = kind, fallback, len(proto.pieces)
    norm = proto.normalizer_spec
    norm.precompiled_charsmap = spec.normalizer_spec.precompiled_charsmap
    norm.add_dummy_prefix, norm.escape_whitespaces, norm.remove_extra_whitespaces = True, True, strip
    path = folder / f"{kind}{fallback}{len(user)}{strip}.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


@pytest.mark.parametrize("kind", [1, 2])
def test_models_with_a_character_map_and_user_defined_pieces(tmp_path, kind):
    import sentencepiece

    from growth_spark.llm.common import Memory

    rng = np.random.default_rng(9)
    texts = ["abc abcde  ab", "①② ﬁ ß é ab　cd ", "<sep>abc<sep> abz", "日本 ab", "  ", "", "aabbccddee" * 20, "z<sep>", "ｆｉ①2"] + ["".join(rng.choice(list("abcdefi12s ①ﬁ"), 40)) for _ in range(60)]
    for fallback, user, strip in ((True, ["<sep>", "ab1"], True), (False, [], False), (False, ["<sep>", "ab1"], False)):
        path = model_file(tmp_path, kind, fallback, user, strip)
        library, model = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_wfst.Transducer(path)
        want = library.encode(texts)
        assert [list(array("i", x)) for x in model.texts(texts, Memory())] == want
        assert [model.decode(array("i", x)) for x in want] == [library.decode(x) for x in want]


def test_a_task_s_memory_is_bounded():
    from growth_spark.llm.common import Memory

    memory = Memory(most=250 * 10)
    for k in range(40):
        with memory.room({f"part{k}": k, "long" * 30 + str(k): k}) as known:
            assert known[f"part{k}"] == known["long" * 30 + str(k)] == k
        assert len(memory.known) <= 10 and not any(len(x) > Memory.LONG for x in memory.known)


def test_language_of_held_out_documents(spark, docs, odd, empty):
    content = language.learn(docs.filter(~language.held_out()))
    rows = language.predict(docs, content).join(docs.select("doc_id", "lang", language.held_out().alias("held")), "doc_id").collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.93
    found = language.predict(odd, content).collect()
    assert len(found) == odd.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in found if r["doc_id"] in (0, 1, 5, 50))
    assert language.predict(empty, language.learn(empty)).count() == 0
    assert language.keep_known(odd).columns == odd.columns


def test_language_margins_and_letters():
    assert language.narrow([100, 100, 160]) and language.narrow([1000, 1004]) and not language.narrow([100, 102]) and not language.narrow([7])
    assert language.letters("½ ² ① 12") == "" and language.letters("हिन्दी x1Y") == "हिन्दी x y" and language.letters("\u0301 1") == ""


def test_texts_of_two_languages_alike_are_rejected(spark):
    rows = [(i, f"the same words here {i % 3}", "en" if i % 2 else "fr", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    content = {"en": b"the same words here", "fr": b"the same words here"}
    assert all(r["rejected"] and r["lang_pred"] == "en" for r in language.predict(docs, content).collect())
    learned = language.learn(docs.withColumns({"at": F.lit(1), "_key": F.lit(2)}))
    assert set(learned) == {"en", "fr"} and learned["en"].count(b"the same words here") == 3  # of twenty rows three texts differ


def brute_windows(texts, units, window, same_document):
    first = {}
    ordered = sorted(texts)
    parts = {d: units(texts[d]) for d in ordered}
    gone = {d: np.zeros(len(parts[d]), bool) for d in ordered}
    for d in ordered:
        own = set()
        for i in range(len(parts[d]) - window + 1):
            w = tuple(parts[d][i : i + window])
            if w in first and (same_document or first[w] < d):
                gone[d][i : i + window] = True
            own.add(w)
            first.setdefault(w, d)
    return parts, gone


def shared_texts():
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(words, 120))
    out = {}
    for d in range(40):
        own = list(rng.choice(words, int(rng.integers(0, 150))))
        at = int(rng.integers(0, len(own) + 1))
        cut = passage.split()[int(rng.integers(0, 60)) :]
        if d % 3 == 0:
            cut = cut[:30] + ["odd"] + cut[30:]
        out[d] = " ".join(own[:at] + (cut if d % 2 else []) + own[at:])
    out[40] = out[3]
    out[41] = "a" * 700
    out[42] = "ab" * 300 + "tail"
    out[43] = ("z " * 130).strip()
    return out


def test_substrings_against_brute_force(spark, odd, empty):
    texts = shared_texts()
    df = spark.createDataFrame([(d, t, None, "s", 0) for d, t in texts.items()], SCHEMA).repartition(5)
    parts, gone = brute_windows(texts, lambda t: t.encode().split(), 50, False)
    assert substring_dedup.levels(50) == [25, 50] and substring_dedup.levels(200) == [25, 50, 100, 200] and substring_dedup.levels(10) == [10]
    check_windows(df, substring_dedup.repeated_windows(df, shortest=4, flush=7), parts, gone, 50)
    for r in substring_dedup.dedup(df).collect():
        d = r["doc_id"]
        assert (r["n_words"], r["n_removed"], r["text"].encode()) == (len(parts[d]), gone[d].sum(), b" ".join(w for w, x in zip(parts[d], gone[d], strict=True) if not x))
    assert substring_dedup.dedup(odd).count() == odd.count() and substring_dedup.dedup(empty).count() == 0


def check_windows(df, found, parts, gone, window):
    from growth_spark.llm.repeats import covered, with_spans

    for r in with_spans(df, found, "doc_id", "text").collect():
        size = len(parts[r["key"]])
        mine = covered(size, [x.asDict() for x in r["spans"]] if r["spans"] else None, window)
        assert (mine if mine is not None else np.zeros(size, bool)).tolist() == gone[r["key"]].tolist()


@pytest.mark.parametrize(("most", "flush", "few"), [(2000, 500_000, 50_000), (1, 500_000, 0), (3, 7, 50_000)])
def test_suffixes_against_brute_force(spark, most, flush, few):
    """Buckets sorted as they are, all anchors crowded, and tasks that hold a few rows at a time."""
    texts = shared_texts()
    df = spark.createDataFrame([(d, t, None, "s", 0) for d, t in texts.items()], SCHEMA).repartition(5)
    parts, gone = brute_windows(texts, lambda t: t.encode(), 100, True)
    check_windows(df, suffix_dedup.repeated_windows(df, most=most, flush=flush, few=few), parts, gone, 100)
    if most == 2000:
        for r in suffix_dedup.dedup(df).collect():
            data, g = parts[r["doc_id"]], gone[r["doc_id"]]
            assert bytes(r["kept"]) == np.frombuffer(data, np.uint8)[~g].tobytes()
            assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), g.sum(), (np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())


def test_rows_without_a_key_or_with_a_repeated_one_keep_their_own_text(spark):
    """Two texts without a key, one key with two texts: each row loses what its own text shares with a smaller key."""
    u, v, w = (" ".join(f"{c}{i}" for i in range(80)) for c in "uvw")
    rows = [(None, u, "", "", 1), (None, w, "", "", 2), (1, u + " q", "", "", 3), (2, v, "", "", 4), (2, u, "", "", 5), (2, u, "", "", 5), (None, w, "", "", 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for found, text in ((substring_dedup.dedup(docs), "text"), (suffix_dedup.dedup(docs), "kept")):
        got = sorted((str(r["doc_id"]), r["n_removed"] > 0, bytes(r[text], "utf8") if text == "text" else bytes(r[text])) for r in found.collect())
        assert got == sorted([("1", False, (u + " q").encode()), ("2", False, v.encode()), ("2", True, b""), ("2", True, b""), ("None", True, b""), ("None", False, w.encode()), ("None", False, w.encode())])
    near = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.cluster(docs).collect())
    assert near == [("1", "1", True), ("2", "1", False), ("2", "1", False), ("2", "2", True), ("None", "1", False), ("None", "None", True), ("None", "None", True)]
    assert sorted(r["n_chars"] for r in near_dedup.keep_first(docs).collect()) == [2, 2, 3, 4]


def test_very_long_texts(spark):
    """Longer than one block of either unit; the second half repeats the first."""
    from growth_spark.llm.common import BLOCK

    words = " ".join(f"w{i % 70001}" for i in range(BLOCK // 4))
    docs = spark.createDataFrame([(1, words, None, "s", 0), (2, "x " + words, None, "s", 0)], SCHEMA).repartition(2)
    found = {r["doc_id"]: r for r in substring_dedup.dedup(docs).collect()}
    assert found[1]["n_removed"] == 0 and found[2]["text"] == "x" and found[2]["n_words"] == BLOCK // 4 + 1
    kept = {r["doc_id"]: r for r in suffix_dedup.dedup(docs).collect()}
    first = " ".join(f"w{i}" for i in range(70001)) + " "
    assert abs(kept[1]["n_bytes"] - kept[1]["n_removed"] - len(first)) <= 8 and kept[2]["n_bytes"] - kept[2]["n_removed"] == 1  # the blank and what follows stand in text 1 too
    near = {r["doc_id"]: r["component_id"] for r in near_dedup.cluster(docs).collect()}
    assert near == {1: 1, 2: 1}


def test_suffix_digests(odd, empty):
    assert suffix_dedup.dedup(odd).count() == odd.count() and suffix_dedup.dedup(empty).count() == 0
    kept = {r["doc_id"]: r for r in suffix_dedup.dedup(odd).collect()}
    assert kept[50]["n_bytes"] == 0 and kept[51]["n_removed"] == 0 and kept[3]["n_removed"] == 4999 and kept[3]["n_spans"] == 1


def test_suffix_sort_is_a_sort():
    rng = np.random.default_rng(2)
    data = bytes(rng.integers(97, 99, 600).astype(np.uint8))
    sorter = suffix_dedup.Suffixes(data)
    at = np.arange(500)
    bucket = at // 130
    order = sorter.sort(at, np.full(500, 40), bucket)
    assert [data[i : i + 40] for i in at[order]] == [x for b in range(4) for x in sorted(data[i : i + 40] for i in at[bucket == b])]


def brute_hits(texts, items):
    low = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    grams = {}
    for k, t in items:
        w = low(t)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(k)
    out = {}
    for d, t in texts:
        w, hit, found = low(t), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if ids := grams.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= ids
        out[d] = (len(w), sorted(hit), sorted(found))
    return out


@pytest.mark.parametrize("most", [decontaminate.MOST_WORDS, 2000])
def test_contamination_against_brute_force(spark, docs, texts, bench, most):
    items = [(r["item_id"], r["text"]) for r in bench.collect()] + [(900, "Short-one item"), (901, None), (902, "--"), (903, "the")]
    both = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_hits(texts.items(), items)
    for r in decontaminate.contamination(docs, both, most=most).collect():
        assert (r["n_words"], sorted(r["hits"]), sorted(r["items"])) == want[r["doc_id"]]


def test_contamination_of_odd_tables(spark, odd, empty, bench):
    assert decontaminate.contamination(odd, bench).count() == odd.count()
    assert decontaminate.contamination(odd, bench.limit(0)).filter(F.size("hits") > 0).count() == 0
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(odd, bench).columns == odd.columns


@pytest.mark.parametrize("most", [decontaminate.MOST_WORDS, 300])
def test_rows_are_judged_by_their_own_text(spark, odd, bench, most):
    """Null and repeated keys with texts of as many words, one of them contaminated, by one part and by several."""
    items = bench.limit(20).collect()
    hit = " ".join(items[0]["text"].split()[:30])
    clean = " ".join(f"q{i}q" for i in range(len(decontaminate.words(hit.encode()))))
    rows = [(None, hit, "en", "s", 1), (None, clean, "en", "s", 2), (7, hit, "en", "s", 3), (7, clean, "en", "s", 4), (7, clean, "en", "s", 4), (8, None, "en", "s", 5)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    small = spark.createDataFrame([(r["item_id"], r["text"]) for r in items], "item_id bigint, text string")
    found = decontaminate.contamination(docs, small, most=most).collect()
    want = sorted((k, bool(t == hit)) for k, t in ((str(r[0]), r[1]) for r in rows))
    assert sorted((str(r["doc_id"]), len(r["hits"]) > 0) for r in found) == want
    left = decontaminate.decontaminate(docs, small, most=most).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in left) == [("7", 4), ("7", 4), ("8", 5), ("None", 2)]
    assert decontaminate.contamination(odd, small, most=most).count() == odd.count()


def test_parts_of_the_benchmark_keep_to_their_bound(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(5 + 7 * (i % 9)))) for i in range(60)] + [(99, " ".join(f"l{j}" for j in range(2000)))]
    df = spark.createDataFrame(items, "item_id bigint, text string")
    cut = decontaminate.in_parts(df.select("item_id", F.col("text").cast("binary").alias("bytes")), "item_id", 13, 1000).cache()
    sizes = {(r["_bucket"], r["_share"]): r["n"] for r in cut.groupBy("_bucket", "_share").agg(F.sum(F.length("bytes")).alias("n")).collect()}
    groups = decontaminate.packed(cut, 1000)
    assert sorted(s for g in groups for s in g) == sorted(sizes) and all(sum(sizes[s] for s in g) <= 1000 for g in groups)

    def windows(rows):
        found = set()
        for i, t in rows:
            w = decontaminate.words(bytes(t))
            n = min(13, len(w))
            found |= {(i, *w[k : k + n]) for k in range(len(w) - n + 1)}
        return found

    assert windows(cut.select("item_id", "bytes").collect()) == windows((i, t.encode()) for i, t in items)


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n")]
    dup, seen = 0, set()
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    from collections import Counter

    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again)


def test_quality_rules(docs, texts, odd, empty):
    for df in (docs, odd):
        want = {r["doc_id"]: brute_rules(r["text"] or "") for r in df.select("doc_id", "text").collect()}
        rows = quality.judge(df).collect()
        assert len(rows) == df.count()
        for r in rows:
            n, *_, again = got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert got == want[r["doc_id"]] and r["base_failed"] == (n < 10 or 100 * again > 20 * n)
            assert not (r["kept"] and r["base_failed"])
    assert quality.judge(empty).count() == 0


def test_hosts_are_shrunk_to_the_common_rate(spark):
    good, bad = "all words here are fine and there are more than ten of them", "# #"
    rows = [(i, good, None, f"g{i % 5}", 0) for i in range(100)] + [(200 + i, bad, None, "bad", 0) for i in range(60)] + [(300, good, None, "bad", 0), (400, bad, None, "once", 0)]
    found = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not found[300]["kept"] and found[300]["host_failed"] and found[0]["kept"] and not found[0]["host_failed"]
    assert found[400]["rate"] < 1 and not found[400]["host_failed"]  # one bad document is too few to tell
    assert all(r["kept"] == (not r["base_failed"] and not r["host_failed"]) for r in found.values())
    # The same host among hosts that are alike falls no more.
    alike = [(i, bad if i % 5 else good, None, f"h{i % 7}", 0) for i in range(300)]
    assert not any(r["host_failed"] for r in quality.judge(spark.createDataFrame(alike, SCHEMA)).collect())


def test_host_verdicts_against_the_formula(spark):
    rng = np.random.default_rng(4)
    hosts = {f"h{k}": (int(rng.integers(1, 200)), float(rng.random() ** 3)) for k in range(30)}
    rows = [(h, bool(rng.random() < p)) for h, (n, p) in hosts.items() for _ in range(n)]
    rules = spark.createDataFrame([(h, x, 20, 100, 0, 0) for h, x in rows], "source string, base_failed boolean, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint")
    n = {h: sum(1 for x, _ in rows if x == h) for h in hosts}
    k = {h: sum(y for x, y in rows if x == h) for h in hosts}
    rates = np.array([k[h] / n[h] for h in hosts])
    m, v = rates.mean(), rates.var()
    w = min(max(m * (1 - m) / v - 1, 1), 1000)
    for r in quality.host_verdicts(rules).collect():
        h = r["source"]
        mean = (k[h] + m * w) / (n[h] + w)
        sure = mean - 2.326 * math.sqrt(mean * (1 - mean) / (n[h] + w + 1))
        assert abs(r["rate"] - mean) < 1e-9 and r["host_failed"] == (sure > 2 * m / (1 + m))


def brute_components(texts):
    sets = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near_texts():
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(500)]
    out, base = {}, list(rng.choice(words, 150))
    for d in range(60):  # copies whose edits leave them near the threshold, a long list in one group
        t = list(base)
        for i in rng.choice(150, int(rng.integers(0, 7)), replace=False):
            t[i] = f"e{d}x{i}"
        out[100 - d] = " ".join(t)
    for d in range(200, 215):
        out[d] = " ".join(rng.choice(words, int(rng.integers(1, 40))))
    out[300], out[301], out[302] = out[200], "A b C", "a B c"
    out[303] = ""
    return out


def test_near_duplicates_against_brute_force(spark, odd, empty):
    texts = near_texts()
    want = brute_components(texts)
    found = near_dedup.cluster(spark.createDataFrame([(d, t, None, "s", 0) for d, t in texts.items()], SCHEMA)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == want
    assert near_dedup.cluster(odd).count() == odd.count() and near_dedup.cluster(empty).count() == 0
    kept = near_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id = 51").count() == 2


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 150)], "a bigint, b bigint")
    from growth_spark.llm.common import Scratch

    found = {r["node"]: r["root"] for r in near_dedup.components(links, Scratch(spark, "chain"), "x").collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 150: 100}


def test_base_spans():
    text = "a.b@c.de, x@y 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 4111 1111 1111 1111 4111111111111112 +49 (30) 1234-567 +1 2"
    found = personal_data.base_spans(text)
    # A run of digits and blanks goes on through 8 4111 …, so the card is part of a longer match that fails.
    assert [(k, text[s:e]) for k, s, e in found] == [("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("ip", "1.2.3.4"), ("ip", "5.6.7.8"), ("phone", "+49 (30) 1234-567")]
    assert personal_data.base_spans("0" * 5000 + "1.2.3.4") == [("ip", 0, 5007)] and personal_data.base_spans("9" * 5000 + ".2.3.4") == []


def test_base_spans_are_the_patterns(texts):
    """Against the patterns as they are written, applied plainly."""
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip, card, phone = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda s: "".join(c for c in s if c in "0123456789")
    luhn = lambda s: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0
    extra = ["a@b@c.d.e x..y@z.q. @a.b %+-@--.--", "1.2.3 1.2.3.4.5 0001.2.3.4 00000000001.2.3.4 1.2.3.400", "+1 (2) 3.4-5 6 7 8 9 +12345678901234567 + 1 +1+234567890123", "1-2 3-4 5-6 7-8 9-0 1-2 3-4 5-6 7-8", "12345678901234567890 4111-1111-1111-1111-"]
    for t in [*texts.values(), *extra]:
        want = [("email", m.start(), m.end()) for m in email.finditer(t)]
        want += [("ip", m.start(), m.end()) for m in ip.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
        want += [("card", m.start(), m.end()) for m in card.finditer(t) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
        want += [("phone", m.start(), m.end()) for m in phone.finditer(t) if 9 <= len(digits(m.group())) <= 15]
        assert personal_data.base_spans(t) == want


def test_personal_data_in_odd_tables(docs, odd, empty):
    weights = personal_data.train(docs)
    found = personal_data.find(odd, weights).collect()
    assert len(found) == odd.count() and personal_data.find(empty, None).count() == 0 and personal_data.train(empty) is None
    clean = {r["doc_id"]: r["text"] for r in personal_data.redact(odd).collect()}
    assert clean[8] == "[IP] [PHONE] [EMAIL]" and clean[50] is None
    assert all(np.isfinite(w).all() for w in (weights or {}).values())


def test_secrets_are_found_and_plain_words_are_not(spark, docs):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = personal_data.train(table)
    _, more = personal_data.all_spans('x token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" y', weights)
    assert [k for k, *_ in more] == ["secret"]
    assert personal_data.all_spans("averyveryverylongword1 and /some/path/to/file01", weights)[1] == []
    # Every secret that is planted in plain sight is found, and hardly anything else is.
    shapes = re.compile(r'AKIA[A-Z0-9]{16}|password=([0-9a-f]{18})|"([0-9a-f]{40})"')
    texts = [r["text"] or "" for r in table.select("text").collect()]
    planted = [(t, m.span(next((i for i in (1, 2) if m.group(i)), 0))) for t in texts for m in shapes.finditer(t)]
    spans = {t: {(s, e) for _, s, e in personal_data.all_spans(t, weights)[1]} for t in texts}
    assert sum(x in spans[t] for t, x in planted) >= 0.95 * len(planted) > 5
    assert sum(map(len, spans.values())) <= 1.1 * len(planted)


def test_reliabilities_tell_good_labelers_from_bad_ones():
    """Two thirds are no spans; labelers 0 and 1 are right nine times of ten, labeler 2 guesses."""
    rng = np.random.default_rng(6)
    truth = rng.random(6000) < 0.33
    votes = np.stack([np.where(rng.random(6000) < p, truth, ~truth) for p in (0.9, 0.9, 0.5)], 1) * 2 - 1
    patterns = {}
    for v in votes.tolist():
        patterns[tuple(v)] = patterns.get(tuple(v), 0) + 1
    table, post = personal_data.reliabilities(patterns)
    by = dict(zip(patterns, post, strict=True))
    assert by[1, 1, -1] > 0.9 and by[-1, -1, 1] < 0.1 and by[-1, -1, -1] == 0
    assert table[1, 0, 2] > 0.85 and table[0, 0, 2] < 0.15 and abs(table[1, 2, 2] - table[0, 2, 2]) < 0.1


def test_spans_never_overlap_and_names_need_support():
    counted = [("secret", (1, 1, 1, 0, 1, 0), (1,) * 16, 90), ("secret", (0, 0, 0, 0, -1, 0), (0,) * 16, 900), ("local_phone", (1, 1, 1, 0, 0), (1,) * 10, 50), ("local_phone", (0, 0, 0, -1, -1), (0,) * 10, 50)]
    weights = personal_data.fitted(counted)
    assert set(weights) == {"secret", "local_phone"} and "person" not in weights
    always = {k: np.append(np.zeros(n), 1.0) for k, n in (("secret", 16), ("local_phone", 10), ("address", 5))}
    always["person"] = np.array([3.0, 3.0, 3.0, 0.0, 0.0, 0.0, -1.0])  # a given name, a title or the word before
    text = "key=abcdefgh-555-123-4567-xyz call (555) 123-4567 or 555-123-4567, Dr. John Smith, 12 Old Baker Street, Over There"
    more = personal_data.all_spans(text, always)[1]
    ordered = sorted((s, e) for _, s, e in more)
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    assert [(k, text[s:e]) for k, s, e in more] == [("local_phone", "(555) 123-4567"), ("local_phone", "555-123-4567"), ("secret", "abcdefgh-555-123-4567-xyz"), ("person", "Dr. John Smith"), ("address", "12 Old Baker Street")]


PAGE = "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/x>Menu one</a></nav><div class='sidebar'>Side words here</div><article><h1>Head &amp; line</h1><p>One  two<br>three<p>Four <b>five</b>.</p><aside>Not this</aside><div class=comments><p>A reader says</p></div></article><footer>Foot words</footer></body></html>"


def test_page_text(spark):
    schema = "page_id bigint, url string, html string"
    rows = [(1, "u", PAGE), (2, "u", None), (3, None, ""), (4, "u", "plain  text"), (4, "u", "plain  text"), (5, "u", "<" * 3000), (6, "u", "<p>" * 3000 + "x")]
    df = spark.createDataFrame(rows, schema).withColumns({"text": F.lit(1), "key": F.lit(2), "_html": F.lit(3), "_key": F.lit(4), "kind": F.lit(5)})
    found = html_text.extract(df).collect()
    by = {r["page_id"]: r["text"] for r in found}
    assert by[1] == "Head & line\n\nOne two three\n\nFour five."
    assert by[2] == by[3] == "" and by[4] == "plain text" and len(found) == 7
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_text.extract(df.limit(0)).count() == 0


def test_pages_without_a_content_element():
    weights = html_text.Weights({})
    page = '<div class="header">Site</div><div id="content"><div class="post-header"><h1>Title here</h1></div><p>Words of text go on</p><div style="display: none">secret</div><div class="alert cookie-notice">Cookies</div></div><div class="side">Other</div>'
    assert html_text.main_text(page, weights) == "Title here\n\nWords of text go on"


LINKS = "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(30))
BLOCKS = [f"<nav><ul>{LINKS}</ul></nav>", f"<aside><ul>{LINKS}</ul></aside>", f"<div class=related>{LINKS}</div>", "<script>" + "x = y + z; " * 400 + "</script>", "<div class=advert>" + "<p>buy this now " * 200 + "</div>", "<div class=comments>" + "<p>a reader says <a>so</a>" * 100 + "</div>"]


@pytest.mark.parametrize("block", BLOCKS)
@pytest.mark.parametrize(("start", "end"), [("<article>", "</article>"), ("<div id=content>", "</div>"), ("", "")])
def test_text_on_both_sides_of_a_left_out_block_stays(spark, block, start, end):
    lead, body = " ".join(f"lead{i}" for i in range(100)), " ".join(f"body{i}" for i in range(150))
    for weights in (html_text.Weights({}), weights_of_table(spark)):
        for one, two in ((lead, body), (body, lead)):
            page = f"<html><body><nav><a href=/>Home page</a></nav>{start}<p>{one}</p>{block}<p>{two}</p>{end}<footer>Foot words</footer></body></html>"
            assert html_text.main_text(page, weights) == f"{one}\n\n{two}"


def weights_of_table(spark, have={}):  # noqa: B006
    if not have:
        have[0] = html_text.Weights(html_text.learn(spark.read.parquet(f"{SF}/pages.parquet")))
    return have[0]


def test_weights_decide_where_no_list_names_an_element(spark):
    """A list of links in plain elements, and text outside of a named element: only learned weights leave them out."""
    learned, none = weights_of_table(spark), html_text.Weights({})
    links = "".join(f"<li><a href=/{i}>Link number {i}</a></li>" for i in range(30))
    text = " ".join(f"word{i}" for i in range(80))
    for page in (f"<body><div><ul>{links}</ul></div><div><p>{text}</p></div></body>", f"<body><div>Site name</div><article><p>{text}</p></article><div>More words</div></body>"):
        assert html_text.main_text(page, learned) == text and html_text.main_text(page, none) != text
    assert min(v for (kind, _), v in learned.odds.items() if kind == "word") < 0


def test_names_of_layouts_and_of_histories_are_no_chrome(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(40))
    aside = " ".join(f"x{i}" for i in range(100))
    for weights in (weights_of_table(spark), html_text.Weights({})):
        for page, want in (
            (f"<article><p>{a}</p><aside>{aside}</aside><p>{b}</p></article>", f"{a}\n\n{b}"),
            (f'<div class="layout with-sidebar"><article><p>{a}</p></article><div class="sidebar">side words</div></div>', a),
            (f'<div class="entry-content no-sidebar"><p>{a}</p></div>', a),
            (f'<article><p class="legal-history">{a}</p><p>{b}</p></article>', f"{a}\n\n{b}"),
        ):
            assert html_text.main_text(page, weights) == want


def test_chrome_outside_of_content_still_parts_it_from_other_text(spark):
    page = f"<html><body><div>Site name</div><nav>{LINKS}</nav><article><p>{'word ' * 50}</p></article><nav>{LINKS}</nav><div>More words</div></body></html>"
    assert html_text.main_text(page, weights_of_table(spark)).split() == ["word"] * 50


def test_pages_of_the_table(spark):
    import html

    for r in html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = r["html"][r["html"].index("<article>") + 9 : r["html"].index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r["text"] == "\n\n".join(b for b in blocks if b)


def test_queries_have_their_columns(spark):
    want = {
        "op2_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        "op5_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        "op10_personal_data": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, SF).columns == columns
    row = next(r for r in queries.QUERIES["op10_personal_data"](spark, SF).collect() if r["spans"])
    base = [s for s in row["spans"].split(",") if s.split(":")[0] in personal_data.KINDS]
    assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
