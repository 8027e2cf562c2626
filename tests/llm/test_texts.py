"""Operators on single texts: tokens, page text, line chunks, toxicity and grades."""

import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lotledger.llm import line_chunks, ordinal_quality, queries, sentencepiece_bpe, text_density, toxicity
from lotledger.llm.common import held_out
from lotledger.session import materialise

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", "  two  spaces\n\n\ttab ", "▁ ▁▁x", "<s> </s> <0x41> <unk>", "日本語テキスト 한국어 ру́сский", "🙂🙂 é\x00",
    "x" * 3000, "ab" * 2000, "the quick brown fox " * 200,
]


def docs(spark, texts, **extra):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def test_ids_as_the_library_gives_them(spark, sf_dir):
    library = sentencepiece_bpe.sentencepiece.SentencePieceProcessor(model_file=MODEL)
    corpus = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    texts = ODD + corpus
    got = sentencepiece_bpe.encode_decode(docs(spark, texts, ids="clash", lang=None), MODEL).orderBy("doc_id").collect()
    want = sentencepiece_bpe.library_ids(MODEL, [t or "" for t in texts])
    assert [r.ids for r in got] == want
    assert [r.decoded for r in got] == library.decode(want)
    assert got[0].asDict().keys() == {"doc_id", "lang", "ids", "decoded"}


def test_tokens_of_an_empty_table(spark):
    assert sentencepiece_bpe.encode_decode(docs(spark, ["a"]).where("false"), MODEL).collect() == []


def test_backtracking_steps_over_incompatible_matches():
    with open(MODEL, "rb") as file:
        encoder = sentencepiece_bpe.Encoder(sentencepiece_bpe.Vocabulary(file.read()))
    words = ["unbelievable", "ationing", "thessshh", "eauxxement", "aaaabbbb", "ofthstthor"]
    want = sentencepiece_bpe.library_ids(MODEL, words)
    assert [np.frombuffer(encoder.encode(w), np.int32).tolist() for w in words] == want
    assert encoder.pairs


PAGE = """<html><head><title>no</title><style>p{}</style></head><body><nav><a href=/>menu</a></nav><div class="cookie-notice">
accept</div><header><h1>Site</h1></header><article><h1>Head&amp;line</h1><p>First <b>bold</b>
 text,&nbsp;long enough to be text.<br>After a break<p>Second unclosed<script>var a = "<p>x</p>";</script> part
</p><form>sign up</form><ul class="comments"><li>reader</li></ul></article><aside>side</aside><footer>foot</footer>"""


def test_main_text_of_a_page():
    want = "Head&line First bold text, long enough to be text. After a break Second unclosed part"
    assert text_density.main_text(PAGE) == want


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("<p>", ""), ("<!-- open", ""), ("plain & <i>e</i>lse", "plain & else"),
    ("<div class=menu>a</div><div><p>Text of some length is here.<p>And more of it.</div><div id=sidebar>b</div>",
     "Text of some length is here. And more of it."),
    ("<form><p>The page lies in a form.</p><p>All of it.</p></form>", "The page lies in a form. All of it."),
])
def test_odd_pages(page, want):
    assert text_density.main_text(page) == want


def test_link_lists_are_thinner_than_text():
    tags, parents = ["body", "div", "a", "a", "p"], [-1, 0, 1, 1, 0]
    density, sums = text_density.densities(tags, parents, [0, 0, 20, 20, 200])
    assert density[4] > density[1] and sums[0] == pytest.approx(density[1] + density[4])


STORY = " ".join(["A long sentence of the story, told without any link."] * 6)
MENU = "<div>" + "".join(f"<div><a href=/{i}>Topic {i}</a></div>" for i in range(30)) + "</div>"


def test_density_chooses_without_telling_names(monkeypatch):
    page = f"<body>{MENU}<div><div><h1>Title of the story</h1><p>{STORY}</p><p>{STORY}</p></div></div>"
    want = f"Title of the story {STORY} {STORY}"
    assert text_density.main_text(page) == want
    monkeypatch.setattr(text_density, "densities", lambda tags, *_: ([1.0] * len(tags), [float(tags.count("a"))] * len(tags)))
    assert text_density.main_text(page) != want


@pytest.mark.parametrize("name", [
    "content", "content with-sidebar", "layout-has-sidebar", "no-sidebar", "share-prices", "post social-policy", "comment-piece",
    "page-banner-open",
])
def test_misleading_names_keep_the_story(name):
    page = f'<body><div class="menu"><a href=/>Home</a></div><div class="{name}"><p>{STORY}</p></div><div class="ad-box">Buy</div>'
    assert text_density.main_text(page) == STORY


@pytest.mark.parametrize("name,want", [
    ("sidebar", 2), ("left-sidebar", 2), ("sidebar-left", 2), ("relatedPosts", 2), ("comment-list", 2), ("ad-slot-3", 2),
    ("with-sidebar", 1), ("share-prices", 1), ("content", 0), ("42", 0), ("", 0),
])
def test_evidence_of_names(name, want):
    assert text_density.name_evidence(name) == want


def test_thin_parts_within_main():
    links = '<div class="rightcol"><h3>Most read</h3><ul><li><a href=1>Link one</a></li><li><a href=2>Link two</a></li></ul></div>'
    assert text_density.main_text(f"<main><h1>Title</h1><div><p>{STORY}</p></div>{links}</main>") == f"Title {STORY}"
    listed = "<ul><li><a href=1>Source one</a></li><li><a href=2>Source two</a></li></ul>"
    assert text_density.main_text(f"<article><p>{STORY}</p>{listed}</article>") == f"{STORY} Source one Source two"


@pytest.mark.parametrize("page", [
    "<textarea " * 50_000, "<div>" * 100_000 + "x", "<div>a " * 80_000, '<a ">" ' * 80_000, "<p><table><td>" + "<div>" * 80_000,
    "<i><div>" + "<b>" * 50_000 + "x</i>" * 50_000, "<script>" + "</script " * 50_000,
], ids=["unclosed", "nested", "text", "quoted", "cell", "inline", "script"])
def test_long_broken_pages_take_time_by_length(page):
    began = time.monotonic()
    text_density.main_text(page)
    assert time.monotonic() - began < 10


def test_a_tag_whose_quote_never_ends_ends_at_its_bracket():
    assert text_density.main_text(f'<p>{STORY}<b class="x>bold</b> end') == f"{STORY}bold end"


def test_pages_query_keeps_rows(spark, sf_dir):
    got = queries.op5_text_density(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    assert got.where("n_chars <> length(text) or n_chars = 0").count() == 0
    pages = spark.createDataFrame([(1, "u", None, "x"), (1, "u", "<p>a", "y")], "page_id int, url string, html string, text string")
    assert sorted((r.page_id, r.text) for r in text_density.extract(pages).collect()) == [(1, ""), (1, "a")]


LONG = " ".join(f"word{i}" for i in range(60))


def removed(spark, texts, ids=None):
    rows = list(zip(ids or range(len(texts)), texts, strict=True))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    return sorted(((r.doc_id, r.text, r.n_removed) for r in line_chunks.remove_repeated(df).collect()), key=repr)


def test_repeated_passages_go_but_once(spark):
    got = removed(spark, [f"a\n{LONG}\nb", f"{LONG}\nc", f"c\n{LONG}", None, "", LONG], [5, 2, 9, 3, 4, None])
    assert (2, f"{LONG}\nc", 0) in got and (5, "a\nb", 1) in got and (9, "c", 1) in got
    assert (3, None, 0) in got and (4, "", 0) in got and (None, LONG, 0) in got


def test_chunks_come_back_after_an_insertion():
    lines = [f"line {i} of a passage" for i in range(40)]
    plain = {k for _, _, k in line_chunks.chunks("\n".join(lines))}
    shifted = {k for _, _, k in line_chunks.chunks("\n".join(["new", "lines", *lines]))}
    assert len(plain & shifted) >= len(plain) - 2 and len(plain) > 5


def test_line_chunks_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    seen, want = set(), {}
    for doc, text in sorted(table.collect()):
        lines, n = text.split("\n"), 0
        for a, b, _ in line_chunks.chunks(text):
            chunk = "\n".join(lines[a:b])
            n += (b - a) * (chunk in seen)
            seen.add(chunk)
        want[doc] = n
    assert {r.doc_id: r.n_removed for r in line_chunks.remove_repeated(table).collect()} == want


def test_line_chunks_of_an_empty_table(spark):
    assert line_chunks.remove_repeated(docs(spark, ["a"]).where("false")).collect() == []


def labelled(spark, n=400):
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        words = ["".join("abcdefghij"[int(d)] for d in str(1000 + (i * 37 + k * k * 11) % 971)) for k in range(12)]
        if bad:
            words.insert(i % 11, ["blorf", "zendish", "zendable", "zendly"][i // 4 % 4])
        rows.append((i, " ".join(words), int(not bad), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")


def test_toxicity_learns_words_and_stems(spark):
    table = labelled(spark)
    model = toxicity.fit(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert "blorf" in model.grammar.words and any(s.startswith("zend") for s in model.grammar.stems)
    more = table.select("doc_id", "text", "toxic", F.lit("clash").alias("score"))
    scored = toxicity.score(more, model).withColumn("out", held_out(F.col("doc_id"))).collect()
    assert all((r.score >= 0.5) == (r.toxic == 1) for r in scored) and any(r.out for r in scored)
    odd = toxicity.score(docs(spark, [None, "", "blorf " * 5000]), model).orderBy("doc_id").collect()
    assert odd[0].score == odd[1].score < 0.5 < odd[2].score


def test_clause_decides_how_an_insult_counts():
    grammar = toxicity.Grammar({"blorf": 4.0}, {"zend": 3.0})
    place = {name: i for i, name in enumerate(toxicity.FEATURES)}

    def has(text, name):
        return grammar.features(text)[place[name]] > 0

    assert has("you are a blorf", "aimed") and has("a blorf, you know", "plain")
    assert has("you are not a blorf", "softened") and not has("you are not a blorf", "aimed")
    assert has("he said she was zendish", "softened") and has("i will kill you", "threat")
    assert not any(grammar.features("kill the process")[place[n]] for n in ("aimed", "plain", "threat"))
    assert not any(grammar.features(None)) and not any(grammar.features("clean text."))


@pytest.mark.parametrize("length", [10, 300, 450, 5000])
def test_clauses_of_any_length_keep_their_denial_and_report(length):
    grammar = toxicity.Grammar({"blorf": 4.0}, {})
    filler = "word " * (length // 5)
    softened, plain = toxicity.FEATURES.index("softened"), toxicity.FEATURES.index("plain")
    for begin in ("they never saw", "he said", "this isn’t", "this isn't"):
        got = grammar.features(f"Before, {begin} {filler} a blorf")
        assert got[softened] > 0 and got[plain] == 0
    got = grammar.features(f"they never saw it. {filler} a blorf")
    assert got[softened] == 0 and got[plain] > 0


def test_toxicity_without_labels(spark):
    table = labelled(spark, 20)
    model = toxicity.fit(table, table.where("false"))
    assert len({r.score for r in toxicity.score(table, model).collect()}) == 1


def test_toxicity_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = queries.op8_toxicity(spark, path).join(labels, "doc_id").where("held_out").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()
    rate = {r.toxic: r.p for r in got}
    assert rate[1] > 0.85 and rate[0] < 0.02


def test_grades_are_ordered():
    random = np.random.default_rng(0)
    x = random.standard_normal((600, 8)).astype(np.float32)
    score = x @ np.arange(8) / 4 + random.standard_normal(600) * 0.3
    grade = np.digitize(score, [-1.5, 1.5])
    model = ordinal_quality.fit_matrix(x, grade, 3)
    tails = model.tails(x)
    assert (np.diff(model.thresholds) > 0).all() and (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails >= 0.5).sum(axis=1) == grade).mean() > 0.85


def test_grades_of_odd_texts_and_empty_labels(spark):
    table = labelled(spark, 60)
    grade = F.col("quality") * (2 - F.col("toxic"))
    model = ordinal_quality.fit(table, table, grade, 3)
    got = ordinal_quality.score(docs(spark, [None, "", "x" * 100_000, "ordinary words here"], tail_probability="clash"), model)
    rows = got.orderBy("doc_id").collect()
    assert len(rows) == 4 and rows[0][1:] != () and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in rows)
    nothing = ordinal_quality.fit(table, table.where("false"), grade, 3)
    assert len({r.expected_grade for r in ordinal_quality.score(table, nothing).collect()}) == 1


def test_quality_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    got = queries.op7_ordinal_quality(spark, path).join(labels, "doc_id").where("held_out")
    rate = {r.quality: r.k for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert rate[1] > 0.97 and rate[0] < 0.3


def brute_passages(rows, window=50):
    """Words that lie in 50 words of the same bytes that occur before."""
    seen, out = {}, {}
    for doc, text in rows:
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        gone = [False] * len(spans)
        for p in range(len(spans) - window + 1):
            d, q = seen.setdefault(text[spans[p][0]:spans[p + window - 1][1]], (doc, p))
            if d < doc or q + window <= p:
                gone[p:p + window] = [True] * window
        out[doc] = [text[a:b] for (a, b), g in zip(spans, gone, strict=True) if not g]
    return out


def test_passages_inside_lines_and_over_short_lines(spark):
    words = [f"word{i}" for i in range(60)]
    short = "\n".join(" ".join(words[i:i + 12]) for i in range(0, 60, 12))
    tail = " ".join(f"tail{i}" for i in range(80))
    rows = [
        (1, f"one {LONG} {tail}"), (2, f"two  {LONG} end\nlast"), (3, f"{short}\nthree"), (4, f"four\n{short}\nafter"),
        (5, f"five words {LONG}"), (6, f"{LONG} six"), (7, " ".join(words[5:54])), (8, f"x {short} y"), (9, "a " * 130),
        (10, f"ten\n{tail[:300]}"), (11, f"{tail} {tail}"), (12, f"m\n\n{short}\n\n{short}"),
    ]
    got = {r.doc_id: r.text for r in line_chunks.remove_repeated(docs(spark, [t for _, t in rows]).select((F.col("doc_id") + 1).alias("doc_id"), "text")).collect()}
    want = brute_passages(rows)
    assert {d: t.split() for d, t in got.items()} == want
    assert got[2] == "two end\nlast" and got[4] == "four\nafter" and got[5] == "five words" and got[6] == "six" and got[8] == "x\ny"


def test_no_passage_stays_twice(spark, sf_dir):
    """Of the words in passages that occur before, none is left in the small table."""
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.text.split() for r in line_chunks.remove_repeated(table).collect()}
    want = brute_passages(sorted(map(tuple, table.collect())))
    assert sum(map(len, want.values())) > 0

    def within(few, many):
        rest = iter(many)
        return all(w in rest for w in few)

    # Repeated chunks of lines go besides, so less may be left.
    assert all(within(got[d], w) for d, w in want.items())


@pytest.mark.parametrize("hot", [0, 2_000])
def test_windows_of_a_segment_are_stored_in_a_row(spark, monkeypatch, hot):
    """One row for each segment that is compared, but for hashes of very many segments; the same text is left."""
    stored = {}

    def spy(df, label, *more):
        stored[label] = out = materialise(df, label, *more)
        if label == "windows":
            stored["rows"] = out.where("not hot").count(), out.where("hot").count()
        return out

    monkeypatch.setattr(line_chunks, "materialise", spy)
    monkeypatch.setattr(line_chunks, "HOT_KINDS", hot)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{' '.join(f'a{i}x{j}' for j in range(40))} {passage} {' '.join(f'b{i}x{j}' for j in range(40))}") for i in range(6)]
    left = {r.doc_id: r.text for r in line_chunks.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left[0] == rows[0][1]
    assert all(left[i] == rows[i][1].replace(passage + " ", "") for i in range(1, 6))
    packed, single = stored["rows"]
    assert (packed == 0 and single > 0) if not hot else (0 < packed < 40 and single == 0)


@pytest.mark.parametrize("hashes", [16, 1_000_000])
def test_segments_are_listed_by_batch(spark, monkeypatch, hashes):
    """Only segments whose hash stands twice get rows of their own, however lists and hashes are dealt out; nothing else changes."""
    rows_of = {}

    def spy(df, label, *more):
        out = materialise(df, label, *more)
        rows_of[label] = out.count()
        return out

    monkeypatch.setattr(line_chunks, "materialise", spy)
    monkeypatch.setattr(line_chunks, "BUCKET_HASHES", hashes)
    monkeypatch.setattr(line_chunks, "LIST_SEGMENTS", 7 if hashes == 16 else 1 << 16)
    rows = [(i, " ".join(f"a{i}x{j}" for j in range(400)) + (f" {LONG}" if i % 8 == 0 else "")) for i in range(40)]
    rows += [(40, "a " * 130), (41, "\u3000".join(f"s{j}" for j in range(60)) * 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = {r.doc_id: r.text.split() for r in line_chunks.remove_repeated(table).collect()}
    assert left == brute_passages(rows)
    # About one segment for every 18 words.
    assert rows_of["segments"] <= (3 if hashes > 16 else 400) and 0 < rows_of["shared-segments"] < 200


def test_words_end_at_every_space():
    wide = ["\x1c", "\x1f", "\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]
    for text in [x.join(["", "é", "日本", "a\u200bb", ""]) for x in wide] + ["".join(wide), "Â", "â\u2027", "ends \u3000", ""]:
        raw = text.encode()
        assert [raw[a:b].decode() for a, b in zip(*line_chunks.words(raw), strict=True)] == text.split()


def test_texts_meet_python_three_times(spark, monkeypatch):
    """One pass lists chunks and segments, one makes windows, one rewrites; chunks of lines are not stored as texts."""
    passes, stored = [], {}

    def spy(df, label, *more):
        stored[label] = materialise(df, label, *more)
        return stored[label]

    kind = type(spark.range(0))
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, f, *more, **named: passes.append(self.columns) or run(self, f, *more, **named))
    monkeypatch.setattr(line_chunks, "materialise", spy)
    lines = "\n".join(f"line {i} of a passage" for i in range(30))
    rows = [(1, f"{lines}\nend"), (2, f"two\n{LONG}"), (3, f"three\n{lines}\n{LONG}\nthree"), (4, None)]
    left = {r.doc_id: (r.text, r.n_lines, r.n_removed > 0) for r in line_chunks.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left == {1: (rows[0][1], 31, False), 2: (rows[1][1], 2, False), 3: ("three\nthree", 33, True), 4: (None, 0, False)}
    assert sum("text" in x for x in passes) == 3
    assert all("string" not in t for df in stored.values() for _, t in df.dtypes)


def test_spaces_and_blank_lines_around_what_is_cut(spark):
    """Texts that are cut together keep the spaces of their own words and lines; a row without an id keeps all."""
    wide = "　".join(f"w{i}" for i in range(55))
    rows = [
        (0, f"{LONG}\n{wide}\n"),
        (1, f"\t {LONG}  tail é \n\n \nlast　"), (2, f"one\xa0two  {wide}　 \n\n{LONG}"), (3, f" \n{wide} \n\n {LONG}\n "),
        (4, f"a\n\n{LONG}\n\nb\n"), (5, "untouched \n\n text"), (None, LONG),
    ]
    left = {r.doc_id: (r.text, r.n_removed, r.n_cut) for r in line_chunks.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert left[0] == (rows[0][1], 0, 0) and left[5] == (rows[5][1], 0, 0) and left[None] == (LONG, 0, 0)
    assert left[1] == ("\t tail é \n\n \nlast　", 0, 60)
    assert left[2] == ("one\xa0two　 ", 1, 55)
    assert left[3][0] == ""
    assert left[4] == ("a\n\n\nb\n", 1, 0)
