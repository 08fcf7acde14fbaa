"""Every operator against a plain version on small rows with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from beatgrid.llm import adaptive_ann, decontaminate, langid_nb, mixing, quality_gbt, sharding, simhash_bk, suffix_merge, template_html, token_histogram

DOCS = "doc_id long, text string, lang string, source string, row string, shard int"


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source); two more columns have names that the operators use."""
    return spark.createDataFrame([(*r, "clash", 9) for r in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma,", "delta", "é", "zeta\n", "eta", "theta|", "iota", "kappa."]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60))), rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None]))
            for i in range(120)]
    rows += [(200, None, None, "c"), (201, "", "en", "c"), (None, "no id at all", "en", "a"), (3, rows[3][1], "en", "a"), (4, "same id other text", "en", "b")]
    return rows + [(300 + i, rows[5][1], "en", "b") for i in range(9)] + [(400, "word " * 30_000, "en", "b")]


def collected(df):
    return [tuple(r) for r in df.collect()]


def test_neighbours_are_found(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((900, 24)) + rng.integers(0, 6, (900, 1)) * 2, 3)
    x[700:720] = x[0]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(1000, None), (1100, [0.0] * 24), (1200, [float("nan")] * 24), (1300, [None] * 24), (1400, [1.0]), (None, rows[1][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = collections.defaultdict(list)
    for q, rank, v, score in collected(adaptive_ann.search(df, lambda i: i % 100 == 0, block_rows=64)):
        assert score == pytest.approx(math.dist(x[q], x[v]), abs=1e-9) and v != q
        found[q].append((rank, score, v))
    assert sorted(found) == list(range(0, 900, 100))
    hits = 0
    for q, near in found.items():
        near.sort()
        assert [r for r, _, _ in near] == list(range(1, 11)) and [n[1:] for n in near] == sorted(n[1:] for n in near)
        true = sorted((math.dist(x[q], x[v]), v) for v in range(900) if v != q)[:10]
        hits += len({v for _, v in true} & {v for _, _, v in near})
    assert hits / 90 >= 0.9


def test_neighbours_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert collected(adaptive_ann.op1_adaptive_neighbours(spark.createDataFrame([], schema))) == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])], schema)
    assert sorted(collected(adaptive_ann.op1_adaptive_neighbours(few))) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]


def test_token_histogram(spark, corpus):
    encoding = token_histogram.load_encoding()
    lengths = [len(encoding.encode(r[1] or "", disallowed_special=())) for r in corpus]
    sums = token_histogram.op2_token_histogram(documents(spark, corpus)).cache()
    rows = sorted(collected(sums.select("n_tokens", "n_docs", "docs_at_least", "tokens_at_least", "truncated_tokens")))
    assert rows == [(n, lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), sum(min(x, n) for x in lengths))
                    for n in sorted(set(lengths))]
    for limit, cut, left in collected(token_histogram.at_limits(sums, [0, 1, 17, 100_000])):
        assert (cut, left) == (sum(x > limit for x in lengths), sum(min(x, limit) for x in lengths))
    for share, n in collected(token_histogram.quantiles(sums, [0.25, 0.5, 1.0])):
        assert n == min(x for x in lengths if sum(y <= x for y in lengths) / len(lengths) >= share)
    assert collected(token_histogram.op2_token_histogram(documents(spark, []))) == []


def test_site_templates_go(spark):
    def page(i):
        return (f"<html><head><title>t</title></head><body><div class=x1>Our <b>slogan</b></div><nav>menu</nav><article><h1>Title {i}</h1>"
                f"<p>Text &amp; more\n of {i}<p>Quoted by all</article><script>var a = '<p>no</p>';</script><div class=comments>hi {i}</div></body></html>")
    rows = [(i, f"https://Host.example/{i}", page(i)) for i in range(12)]
    rows += [(20, None, "<p>a<div class=x1>b</div>"), (21, "https://host.example/z", None), (22, "bad", ""), (23, "https://host.example/u", "<div class=x1>Our <b>slogan</b></div><p>left")]
    found = {r[0]: r[2:] for r in collected(template_html.op3_site_text(spark.createDataFrame(rows, "page_id long, url string, html string")))}
    for i in range(12):
        text = f"Title {i}\nText & more of {i}\nQuoted by all"
        assert found[i] == (text, len(text))
    assert found[20] == ("a\nb", 3) and found[21] == ("", 0) and found[22] == ("", 0) and found[23] == ("left", 4)
    assert collected(template_html.op3_site_text(spark.createDataFrame([], "page_id long, url string, html string"))) == []


@pytest.mark.parametrize("length, hot", [(20, 100_000), (41, 100_000), (20, 3), (41, 0)])
def test_repeated_bytes(spark, length, hot):
    rng = random.Random(length)
    shared = ["".join(rng.choices("abcd é", k=90)) for _ in range(3)]
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 120))) + rng.choice(shared)[rng.randint(0, 30):] + "".join(rng.choices("xyz", k=9)) for _ in range(40)]
    texts += [None, "", "ab" * 60, texts[0], texts[0], "q" * 200, shared[0]]
    raw = [(t or "").encode() for t in texts]
    starts = collections.Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    expected = []
    for i, t in enumerate(raw):
        gone = {j for k in range(len(t) - length + 1) if starts[t[k:k + length]] > 1 for j in range(k, k + length)}
        kept = bytes(b for j, b in enumerate(t) if j not in gone)
        expected.append((i, len(t), len(gone), sum(j - 1 not in gone for j in gone), hashlib.sha256(kept).hexdigest()))
    found = suffix_merge.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length=length, hot_suffixes=hot)
    assert sorted((r["row"]["doc_id"], r["n_bytes"], r["n_removed"], len(r["removed_runs"]), r["kept_sha256"]) for r in found.collect()) == expected


def test_no_documents_lose_nothing(spark):
    assert collected(suffix_merge.op4_repeated_bytes(documents(spark, []))) == []


@pytest.mark.parametrize("slice_windows", [200_000, 3])
def test_benchmark_hits(spark, slice_windows):
    rng = random.Random(8)
    words = ["One", "two", "é", "x9", "five"]
    items = [(i, " ".join(rng.choices(words, k=k))) for i, k in enumerate([0, 1, 3, 12, 25, 3])] + [(7, None), (None, "nameless words here")]
    docs = [(i, rng.choice([", ", " ", "-"]).join(rng.choices(words[1:], k=rng.randint(0, 30)))) for i in range(40)]
    docs += [(50, None), (51, "so " + items[4][1].upper().replace(" ", "; ")), (52, "nameless, words here"), (50, "")]

    def split(t):
        return decontaminate.WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    expected = []
    for i, text in docs:
        w, hit, names = split(text), set(), set()
        for item, value in items:
            v = split(value)
            size = min(10, len(v))
            for window in [v[k:k + size] for k in range(len(v) - size + 1)] if v else []:
                for k in range(len(w) - size + 1):
                    if w[k:k + size] == window:
                        hit.update(range(k, k + size))
                        names.add("null" if item is None else str(item))
        expected.append((i, len(w), len(hit), tuple(sorted(names))))
    found = decontaminate.scan(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame(items, "item_id long, text string"), slice_windows=slice_windows).collect()
    got = [(r["row"]["doc_id"], r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["spans"]), tuple(r["items"])) for r in found]
    assert sorted(got) == sorted(expected)
    for r in found:
        for s, o in zip(r["spans"], r["offsets"]):
            assert split(r["row"]["text"][o["start"]:o["stop"]]) == split(r["row"]["text"])[s["first"]:s["last"] + 1]


def test_quality_on_held_out_rows(spark):
    rng = random.Random(4)
    good = [" ".join(rng.choices(["the", "river", "flows", "slowly", "home."], k=40)) for _ in range(400)]
    bad = [" ".join(rng.choices(["$$$", "|", "BUY", "12345", "#"], k=40)) for _ in range(400)]
    rows = [(i, t, "en", "a") for i, t in enumerate(good + bad)] + [(9000, None, None, None), (9001, "", None, None), (None, "x", None, None)]
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(800)] + [(5, None), (None, 1)], "doc_id long, quality int")
    found = collected(quality_gbt.op6_quality_scores(documents(spark, rows), labels))
    assert len(found) == len(rows)
    for i, held, score, predicted in found:
        assert held == (zlib.crc32(str("" if i is None else i).encode()) % 5 == 0) and 0 <= score <= 1 and predicted == int(score >= 0.3)
        assert i is None or i >= 9000 or predicted == int(i < 400)
    none = quality_gbt.op6_quality_scores(documents(spark, rows[:3]), labels.limit(0))
    assert {r[2] for r in collected(none)} == {0.5}
    assert collected(quality_gbt.op6_quality_scores(documents(spark, []), labels)) == []


def test_mix_meets_targets(spark, corpus):
    found = collected(mixing.op7_source_mix(documents(spark, corpus)))
    assert len(found) == len(corpus)
    sizes, source_of = collections.Counter(), {}
    for i, text, _, source in corpus:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        source_of.setdefault(i, source)
    names = sorted(s for s in sizes if s is not None) + [None]
    weight, open_, target = dict(zip(names, [5, 2, 1, 5])), set(names), {}
    while True:
        rest = sum(sizes.values()) - sum(target.values())
        over = [s for s in open_ if rest * weight[s] / sum(weight[x] for x in open_) > 3 * sizes[s]]
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= set(over)
    target |= {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
    assert {(r[2], round(r[3], 6)) for r in found} == {(sizes[s], round(target[s], 6)) for s in names}
    assert all(r[4] <= 3 * r[1] and (not r[1] or r[4] % r[1] == 0) for r in found)
    assert sorted(found, key=str) == sorted(collected(mixing.op7_source_mix(documents(spark, corpus))), key=str)
    for s in ("a", None):
        taken = sum(r[4] for r in found if source_of.get(r[0]) == s)
        assert abs(taken - target[s]) <= 0.1 * target[s] + 150
    assert collected(mixing.op7_source_mix(documents(spark, []))) == []


def test_shards_move_few_rows(spark, corpus):
    found = collected(sharding.op8_rendezvous_shards(documents(spark, corpus)))
    slots = collections.defaultdict(list)
    for _, _, _, law, shard, slot, grown in found:
        assert law == "key" and grown in (shard, 16) and 0 <= shard < 16
        slots[shard].append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in corpus]
    assert sorted((r[:3] for r in found), key=str) == sorted(expected, key=str)
    whole = sharding.shard_documents(documents(spark, corpus))
    assert whole.columns == ["doc_id", "text", "lang", "source", "row", "shard", "slot"] and whole.count() == len(corpus)
    assert collected(sharding.op8_rendezvous_shards(documents(spark, []))) == []


def test_languages_on_held_out_rows(spark):
    rng = random.Random(6)
    vocabulary = {"en": ["the", "water", "with", "which"], "de": ["über", "nicht", "auch", "straße"], "ru": ["река", "дом", "это", "вода"]}
    rows = [(i, " ".join(rng.choices(vocabulary[lang], k=15)), lang, "a") for i, lang in enumerate(rng.choices(list(vocabulary), k=300))]
    rows += [(900, None, "en", None), (901, "12 !?", "de", None), (902, "", None, None), (903, "nicht auch über", None, None), (904, "the water " * 150_000, None, None)]
    found = {r[0]: r[1:] for r in collected(langid_nb.op9_languages(documents(spark, rows)))}
    assert all(found[i][1] == lang for i, _, lang, _ in rows[:300])
    assert [found[i][1:] for i in (900, 901, 902)] == [("und", 0.0)] * 3 and found[903][1] == "de" and found[904][1] == "en"
    assert collected(langid_nb.op9_languages(documents(spark, []))) == []
    unlearned = langid_nb.op9_languages(documents(spark, [(1, "text", None, None)]))
    assert [r[2] for r in collected(unlearned)] == ["und"]


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values):
    label = list(range(len(values)))
    for _ in values:
        before = list(label)
        for a in range(len(values)):
            for b in range(a):
                if (values[a] ^ values[b]).bit_count() <= 2:
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_simhash_groups(spark, corpus):
    rows = [r for r in corpus if r[0] is not None and r[:2] != (4, "same id other text")]
    rows = list({r[0]: r for r in rows}.values())
    values = [plain_fingerprint(r[1]) for r in rows]
    label = plain_groups(values)
    least = [min(rows[j][0] for j in range(len(rows)) if label[j] == label[i]) for i in range(len(rows))]
    expected = sorted((r[0], f"{v:016x}", c) for r, v, c in zip(rows, values, least))
    assert sorted(collected(simhash_bk.op10_simhash_groups(documents(spark, rows)))) == expected
    assert sorted(r["doc_id"] for r in simhash_bk.keep_one(documents(spark, rows)).collect()) == sorted(set(least))
    assert collected(simhash_bk.op10_simhash_groups(documents(spark, []))) == []


def test_crowded_shards_lose_no_link(spark):
    rng = random.Random(2)
    values = list({rng.getrandbits(10) << 40 for _ in range(90)} | {rng.getrandbits(63) for _ in range(30)})
    distinct = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    from beatgrid.llm.components import components
    groups = {r[0]: r[1] for r in collected(components(simhash_bk.link_shards(simhash_bk.sharded(distinct, limit=8))))}
    pairs = {}
    for v, l in zip(values, plain_groups(values)):
        pairs.setdefault(l, set()).add(v)
    named = collections.defaultdict(set)
    for v in values:
        named[groups.get(v, v)].add(v)
    assert sorted(map(sorted, named.values())) == sorted(map(sorted, pairs.values()))


def test_documents_that_share_an_id_are_told_apart(spark):
    rows = [(1, "one two three four", None, None), (1, "quite another text here", None, None), (1, "one two three four", None, None), (2, "ONE two three four", None, None)]
    kept = simhash_bk.keep_one(documents(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "row", "shard"]
    assert sorted(r[:2] for r in collected(kept)) == [(1, "one two three four"), (1, "quite another text here")]
