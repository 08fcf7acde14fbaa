"""Texts and tables that are long, odd or many: very long runs, many words, many languages, broken pages."""

import random

import pytest

from beatgrid.llm import decontaminate, langid_nb, template_html, token_histogram


def test_long_runs_of_white_space():
    encoding = token_histogram.load_encoding()
    plain = lambda t: len(encoding.encode(t, disallowed_special=()))
    rng = random.Random(1)
    parts = [" " * 100_000, "\n" * 120_000, "\t \n　" * 30_000, "word", " x", "\n", "é1", "  ", "'s", "\x1c" * 100_001]
    for _ in range(12):
        text = "".join(rng.choices(parts, k=5))
        assert token_histogram.encoded_length(text, encoding) == plain(text)
    for run in (" ", "\n", " "):
        for after in ("", "a", "\x1c", "!"):
            assert token_histogram.encoded_length("x" + run * 150_000 + after, encoding) == plain("x" + run * 150_000 + after)


def test_two_million_blanks(spark):
    docs = spark.createDataFrame([(1, " " * 2_000_000 + "a"), (2, "a" + " " * 2_000_000), (3, None)], "doc_id long, text string")
    rows = token_histogram.op2_token_histogram(docs).collect()
    assert sum(r["n_docs"] for r in rows) == 3


@pytest.mark.parametrize("one_character", [5, 10 ** 6])
def test_codes_of_one_and_two_characters(one_character):
    rng = random.Random(4)
    words = [f"w{i}".encode() for i in range(60)]
    windows = list({b" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(80)})
    codes, automaton, width = decontaminate.build_automaton([(w, str(i)) for i, w in enumerate(windows)], one_character)
    assert width == (2 if one_character == 5 else 1)
    for _ in range(50):
        text = rng.choices([*words, b"unknown"], k=80)
        hit, names = set(), set()
        for i, w in enumerate(windows):
            own = w.split(b" ")
            for at in range(len(text) - len(own) + 1):
                if text[at:at + len(own)] == own:
                    hit.update(range(at, at + len(own)))
                    names.add(str(i))
        coded = "".join(codes.get(w, decontaminate.UNKNOWN * width) for w in text)
        spans, found = decontaminate.find(coded, automaton, width)
        assert {x for a, b in spans for x in range(a, b + 1)} == hit and found == names


def test_more_words_than_characters():
    windows = [(b" ".join(b"%d" % (i * 10 + k) for k in range(10)), "item") for i in range(120_000)]
    codes, automaton, width = decontaminate.build_automaton(windows)
    assert width == 2 and len(codes) == 1_200_000
    coded = "".join(codes[w] for w in windows[119_999][0].split(b" "))
    assert decontaminate.find(decontaminate.UNKNOWN * 2 + coded, automaton, 2) == ([(1, 10)], {"item"})


def test_three_hundred_languages(spark):
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 900)]
    words = {f"l{i:03d}": ["".join(letters[i * 3:i * 3 + 3][k % 3] for k in rng.choices(range(3), k=4)) for _ in range(6)] for i in range(300)}
    rows = [(n, " ".join(rng.choices(words[name], k=12)), name) for n, name in enumerate(sorted(words) * 5)] + [(9000, None, None), (9001, "1 2 3", "l001")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    grams = langid_nb.gram_table(docs)
    texts = docs.select("doc_id", "text")
    got = [{r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid_nb.identify(texts, langid_nb.models(grams, n)).select("row.doc_id", "lang_pred", "score").collect()}
           for n in (1000, 70)]
    assert got[0].keys() == got[1].keys() and len(got[0]) == 1502
    for k, (name, score) in got[0].items():
        assert got[1][k][0] == name and got[1][k][1] == pytest.approx(score, abs=1e-9)
    assert got[0][9000] == ("und", 0.0) == got[0][9001]
    assert sum(got[0][n][0] == name for n, _, name in rows[:-2]) > 1450
    assert {r["lang_pred"] for r in langid_nb.op9_languages(docs).collect()} >= {"l299", "und"}


@pytest.mark.parametrize("page, text", [
    ('<article><p>a</p><svg class="i"/><p>b</p></article>', "a\nb"),
    ("<article><p>a <svg viewBox='0 0 1 1'><title>icon</title><svg><path/></svg></svg>tail</p><svg><p>b</p></article>", "a tail\nb"),
    ("<p>x<math><mi>y</mi></math>z</p>", "xz"),
    ('<body><div id="main-content"><div class="comment-free reading"><p>Body text</p></div></div></body>', "Body text"),
    ('<div id=content class="search-results"><p>real</p></div>', "real"),
    ("<body><nav data=x/>menu</nav><p>text</p></body>", "text"),
    ('<body><div class="sidebar">aside</div><p>text</p></body>', "text"),
    ("<nav>only a menu</nav>", ""),
])
def test_pages_that_lost_or_leaked_text(page, text):
    assert template_html.main_text(page, frozenset()) == text
