"""Rules of single operators at their edges: language dictionaries, personal data, page text, benchmark items without id."""

import re
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from growth_spark.llm import decontaminate, html_text, language, personal_data, queries

SF = "/root/testdata/sf0.001"


# --- language -----------------------------------------------------------------------------------------------------------


def plain_language(text, content):
    """(language, score, rejected), every frame compressed anew."""
    data = language.letters(text).encode()
    if not data:
        return "und", 0.0, True

    def sizes(frame, step):
        out = []
        for name in sorted(content):
            d = zstandard.ZstdCompressionDict(content[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=language.LEVEL)
            c = zstandard.ZstdCompressor(dict_data=d, level=language.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            out.append(sum(len(c.compress(data[i : i + frame])) for i in range(0, len(data), step)))
        return out

    def score(found):
        return 1 / sum(2.0 ** -min(x - min(found), 60) for x in found)

    found = sizes(language.FRAME, language.FRAME)
    if score(found) < language.DOUBT:
        found = [a + b for a, b in zip(found, sizes(language.FINE, language.FINE // 2), strict=True)]
    first, second = sorted(found)[:2]
    return sorted(content)[found.index(first)], score(found), second - first < max(language.BYTES, language.SHARE * first)


def test_languages_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    content = {k: v[:60_000] for k, v in language.learn(spark.read.parquet(f"{SF}/documents.parquet").filter(~language.held_out())).items()}
    texts = {r["doc_id"]: (r["text"] or "")[:3000] for r in docs.collect()}
    cut = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for r in language.predict(cut, content).collect():
        name, score, rejected = plain_language(texts[r["doc_id"]], content)
        assert (r["lang_pred"], r["rejected"]) == (name, rejected) and abs(r["score"] - score) < 1e-12


def test_dictionaries_hold_whole_texts_of_any_number_of_languages(spark):
    rows = [(i, f"words of language number {i % 90} and row {'abcdefgh'[i // 90]}", f"l{i % 90}") for i in range(720)]
    found = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert len(found) == 90 and all(v.count(b"words of language number and row") == 8 for v in found.values())
    long_ = "long text " * 80_000
    rows = [(1, long_, "a"), (2, "short one", "a"), (3, long_, "b"), (4, long_ + "x", "b"), (5, None, "c"), (6, "12", "d"), (7, "no label", None)]
    found = language.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert found["a"] == b"short one" and found["b"] in (long_.strip().encode(), (long_ + "x").encode()) and set(found) == {"a", "b"}
    few = language.learn(spark.createDataFrame([(i, f"text {'abcdefghij'[i]}", "a") for i in range(10)], "doc_id bigint, text string, lang string"), rows=4)
    assert few["a"].count(b"text") == 4


# --- personal data ------------------------------------------------------------------------------------------------------

LOOK_BEHIND = {"local_phone": r"(?<![0-9A-Za-z+.(-])", "secret": "", "person": r"(?<![\w@])", "address": r"(?<![\w.])"}
PATTERNS = {"local_phone": personal_data._LOCAL_PHONE, "secret": personal_data._SECRET, "person": personal_data._PERSON, "address": personal_data._ADDRESS}


def test_candidates_are_a_scan_with_look_behind(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["A55 555-123-4567 end", "(12) 12 555-123-4567", "_Alice Smith Jones", "Paris. Alice Smith", "(Alice Smith) x12 Main Street 12 Main Street", "é" + "a1" * 20, "12-12-12-" * 3000 + "x"]
    titles = "|".join(personal_data.TITLES)
    for kind, pattern in PATTERNS.items():
        own = pattern.pattern
        if kind == "person":  # a dot only behind a title
            own = rf"(?:(?:{titles})\.|[A-Z][a-z]++(?!\.)){own[len('[A-Z][a-z]++') + len(chr(92)) + 2:]}"
        scan = re.compile(LOOK_BEHIND[kind] + own)
        for t in texts:
            assert [m.span() for m in personal_data.placed(kind, pattern, t)] == [m.span() for m in scan.finditer(t)], (kind, t[:80])


@pytest.mark.parametrize(("text", "kind", "span"), [("A55 555-123-4567 end", "local_phone", "555-123-4567"), ("(12) 12 555-123-4567", "local_phone", "(12) 12 555-123-4567"), ("_Alice Smith Jones", "person", "Smith Jones"), ("Paris. Alice Smith", "person", "Alice Smith"), ("+1 (826) 555-4081 190", "local_phone", "(826) 555-4081")])
def test_a_match_at_a_wrong_place_swallows_nothing(text, kind, span):
    assert (kind, span) in [(k, text[s:e]) for k, s, e, *_ in personal_data.candidates(text, [])]


def test_the_classifier_outweighs_votes():
    """A vote is turned down where the span's features are those of no spans, and a span is found without any vote."""
    key, word = "tok" + "3f9A1c7Q" * 3, "interoperationalisation"
    plain = lambda own, named: personal_data.secret_votes(own, "token" if named else "", False, False, False)
    counted = [("secret", *plain(key, True), 60), ("secret", *plain(word, False), 400), ("secret", *plain(word, True), 2), ("secret", *plain(key, False), 3)]
    quoted = personal_data.secret_votes(key, "token", True, True, False)
    weights = personal_data.fitted([*counted, ("secret", *quoted, 40)])
    assert 1 in plain(word, True)[0]
    assert personal_data.all_spans(f"token {word}", weights)[1] == []
    assert [(k, s) for k, s, _ in personal_data.all_spans(f"see {key}", weights)[1]] == [("secret", 4)]


# --- page text ----------------------------------------------------------------------------------------------------------

INSIDE = ['<section class="related-work">{}</section>', '<p class="share-price">{}</p>', '<p class="form-factor">{}</p>', '<blockquote class="comment">{}</blockquote>', '<p class="ad-hoc">{}</p>', '<div class="foot-notes">{}</div>', '<p title="a hidden gem">{}</p>', '<div class="search-results">{}</div>', '<p data-note="display: none">{}</p>']
CHROME = ['<div class="share-buttons">{}</div>', '<div class="ad">{}</div>', '<ul class="related_posts"><li>{}</ul>', '<p hidden>{}</p>', '<p style="color:red; display : none">{}</p>', '<div class="comment-list">{}</div>', '<nav>{}</nav>', '<div id="cookie-banner">{}</div>', '<aside>{}</aside>', "<div HIDDEN=''>{}</div>"]


@pytest.mark.parametrize("page", ["<body><article><p>First words of it.</p>{}<p>Last words of it.</p></article></body>", '<body><div id="content"><p>First words of it.</p>{}<p>Last words of it.</p></div></body>'])
def test_names_that_tell_of_something_else_are_no_chrome(page):
    weights = html_text.Weights({})
    for block in INSIDE:
        assert html_text.main_text(page.format(block.format("some own words")), weights) == "First words of it.\n\nsome own words\n\nLast words of it.", block
    for block in CHROME:
        assert html_text.main_text(page.format(block.format("some own words")), weights) == "First words of it.\n\nLast words of it.", block


def test_depth_costs_no_more_than_length():
    weights = html_text.Weights({})

    def seconds(n):
        start = time.perf_counter()
        deep = "<article>" + "<b>" * n + "".join("</i><section>w</section>" for _ in range(n)) + "</article>"
        assert html_text.main_text(deep, weights).count("w") == n
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(16_000) < 12 * max(seconds(4000), 0.05)


# --- decontamination ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("most", [decontaminate.MOST_WORDS, 40])
def test_items_without_an_id(spark, most):
    """They hit like others, and come last in the list."""
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = spark.createDataFrame([(None, words), (2, words), (1, "short item"), (None, None)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"x {words} y"), (2, "a short item"), (3, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, items, most=most).collect()}
    assert sorted(found[1]["items"], key=lambda x: (x is None, x)) == [2, None] and found[2]["items"] == [1] and found[3]["items"] == []
    assert len(found[1]["hits"]) == 14
    assert decontaminate.decontaminate(docs, items, most=most).count() == 1


def test_no_query_of_these_has_lost_a_column(spark):
    want = {"op3_language": {"doc_id", "held_out", "lang_pred", "score"}, "op10_personal_data": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"}, "op11_bit_clusters": {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"}, "op12_scaled_sketch": {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"}, "op13_conversation_repair": {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"}}
    for name, columns in want.items():
        df = queries.QUERIES[name](spark, SF)
        assert columns <= set(df.columns)
        assert df.filter(F.lit(False)).count() == 0
