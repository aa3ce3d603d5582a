"""Every operator over nulls in all columns, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from gridloom.llm import chat_format, decontaminate, histogram_shards, jaccard_join, language_id, quality_rules, substring_dedup, token_counts, url_filter
from gridloom.llm.common import work_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHARED = " ".join(f"s{i}" for i in range(80))
BASE = " ".join(f"b{i % 37}x{i}" for i in range(300))
TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "four words are here",
    SHARED,
    "before " + SHARED + " after",
    SHARED + " tail " + " ".join(f"t{i}" for i in range(60)),
    BASE,
    BASE,
    BASE + " more",
    "x " + BASE[: len(BASE) // 2] + " changed " + BASE[len(BASE) // 2 :],
    "line a\nline b\nline a\n\n\nline a",
    "ha " * 4000,
    " ".join(f"w{i * 7919 % 5003}" for i in range(30000)),
    "Ünïcödé ☃ 中文 " * 20,
    "a\x0bb\x0cc\rd",
    "A" * 100000,
    "12 34 ### !!",
    BASE.upper(),
]


def documents(spark, texts=TEXTS):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", len(t or ""), "clash", 7, 1.5) for i, t in enumerate(texts)]
    rows += [rows[8], rows[0], (None, BASE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, n_words int, `key` double").repartition(3)


def rows_of(spark):
    return [(r[0], r[1]) for r in documents(spark).collect()]


def test_quality_rules(spark):
    got = quality_rules.quality_rules(documents(spark)).collect()
    assert len(got) == len(TEXTS) + 4 and quality_rules.quality_rules(documents(spark).limit(0)).count() == 0
    want = Counter()
    for i, text in rows_of(spark):
        words = WORD.findall(text or "")
        threes = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        times = Counter(threes)
        covered = {k + j for k, t in enumerate(threes) if times[t] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want[i, len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert all(r.kept == (not r.base_failed) for r in got)  # too few rows for an estimate


def test_quality_rules_reject_outliers_per_group(spark):
    draw = np.random.default_rng(2)
    vocabulary = ["".join(draw.choice(list("abcdefgh"), draw.integers(3, 8))) for _ in range(4000)]
    rows = [(i, " ".join(draw.choice(vocabulary, 120)), "en", "a" if i % 3 else "b") for i in range(400)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in draw.choice(vocabulary, 120)), "en", "a") for i in range(20)]
    got = {r.doc_id: r.kept for r in quality_rules.quality_rules(spark.createDataFrame(rows + bad, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(400)) and not any(got[1000 + i] for i in range(20))


def test_estimate_is_the_best_of_its_steps(spark):
    """Every further concentration step leaves the subset as it is, and the determinant is below the whole's."""
    draw = np.random.default_rng(4)
    x = draw.normal(0, 100, (500, 4)).round()
    x[:60] += 2000
    rows = spark.createDataFrame([("g", "h", *map(int, r)) for r in x], "group_lang string, group_source string, x0 long, x1 long, x2 long, x3 long")
    est = quality_rules.estimates(rows).first().asDict()
    mean = np.array([est[f"m{i}"] for i in range(4)])
    assert np.abs(mean - x[60:].mean(axis=0)).max() < 25
    low = np.zeros((4, 4))
    for i in range(4):
        for j in range(i + 1):
            low[i, j] = est[f"l{i}{j}"]
    floor = np.diag((quality_rules.SCALE * np.array(quality_rules.FLOORS)) ** 2)
    y = np.linalg.solve(low, (x - mean).T)
    step = np.floor(32 * np.log1p((y * y).sum(axis=0)))
    near = x[step <= np.percentile(step, 75)]
    cov = np.cov(near.T, bias=True) * quality_rules._consistency(0.75) + floor
    assert np.allclose(near.mean(axis=0), mean) and np.allclose(low @ low.T, cov)


def test_url_filter(spark):
    urls = [None, "", "no scheme/en/", "://", "HTTP://EXAMPLE.COM/en/7?x", "http://com/en/", "http://xcom/en/7", "http://a.example.com/en/71", "http://a.example.com/en/6#t", "http://example.net/de/8", "http://b.net/de/8/9", "http://x.org?/es/", "http://x.org/es/?q", "http://é.org/es/1", "http://example.com"]
    pages = spark.createDataFrame([(i if i else None, u, "c", "d") for i, u in enumerate([*urls, urls[4]])], "page_id long, url string, URL string, host string")
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in url_filter.url_filter(pages, url_filter.RULES).collect()}
    want = {}
    for i, url in enumerate([*urls, urls[4]]):
        host, path = url_filter.split_url(url)
        fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[i if i else None, host, path] = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    assert got == want and want[4, "example.com", "/en/7"] == ("example.com/en/7", "allow")
    assert url_filter.url_filter(pages.limit(0), []).count() == 0


def test_digest_array_confirms_strings(tmp_path):
    path = str(tmp_path / "a.bin")
    (tmp_path / "a.bin").write_bytes(url_filter.digest_array([(f"h{i}.com", "/p", "block") for i in range(1000)]))
    digests = url_filter.DigestArray(path)
    assert [bool(x >= 0) for x in digests.probe(["h7.com/p", "h7.com/q", "h1000.com/p"])] == [True, False, False]
    digests.keys = np.sort(np.full(1000, digests.keys[0]))  # every digest collides
    import xxhash

    digests.keys[:] = xxhash.xxh64_intdigest(b"h7.com/p")
    assert digests.text(digests.probe(["h7.com/p"])[0]) == b"h7.com/p"
    (tmp_path / "b.bin").write_bytes(url_filter.digest_array([]))
    path = str(tmp_path / "b.bin")
    assert url_filter.DigestArray(path).probe(["x"]) == [-1]


@pytest.mark.parametrize("tolerance", [0, 500])
def test_histogram_shards(spark, tolerance):
    got = histogram_shards.histogram_shards(documents(spark), 8, parts=20, tolerance=tolerance).collect()
    rows = [(hashlib.md5((t or "").encode()).hexdigest()[:15], -1 << 63 if i is None else i, len((t or "").encode()) + 1, i, t) for i, t in rows_of(spark)]
    assert Counter((r.doc_id, r.text, r.size) for r in got) == Counter((i, t, s) for *_, s, i, t in rows)
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    order = sorted((hashlib.md5((r.text or "").encode()).hexdigest()[:15], -1 << 63 if r.doc_id is None else r.doc_id, r.shard, r.slot) for r in got)
    assert [x[2:] for x in order] == sorted(x[2:] for x in order)  # the shards' order is the keys'
    if not tolerance:
        total, below = sum(r[2] for r in rows), 0
        groups = defaultdict(list)
        for r in sorted(rows, key=lambda r: r[:2]):
            groups[r[:2]].append(r)
        where = defaultdict(set)
        for r in got:
            where[r.doc_id, r.text].add(r.shard)
        for members in groups.values():
            assert where[members[0][3], members[0][4]] == {8 * below // total}
            below += sum(m[2] for m in members)
    assert histogram_shards.histogram_shards(documents(spark).limit(0)).count() == 0


def test_hot_text_is_divided(spark):
    rows = spark.createDataFrame([(i, "same" if i % 2 else f"text {i}") for i in range(4000)], "doc_id long, text string")
    got = histogram_shards.histogram_shards(rows, 8).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 40


def test_language_id(spark):
    docs = documents(spark)
    network = language_id.fit(docs)
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(docs, network).collect()}
    assert {p for i, p in got if i in (0, 1, 2, 18)} == {"und"} and {p for i, p in got if i in (3, 8, 15)} == {"en"}
    assert language_id.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    kept = language_id.identified(docs, network)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) + 4 - 6


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in language_id.identify(docs, language_id.fit(docs)).collect()}
    out = [(got[r.doc_id].lang_pred, r.lang) for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(a == b for a, b in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_gradients_are_right():
    network = language_id.Network(["a", "b", "c"], hidden=4)
    network.weights = [w.astype(np.float64) for w in network.weights]
    items = [b" ab ", " é".encode(), b" hello "]
    x = np.stack([np.frombuffer(i.ljust(8), np.uint8) for i in items], axis=1).astype(np.int64)
    mask, y = language_id._LETTER[x].astype(np.float64), np.array([0, 1, 2])
    _, gradients = network.gradients(x, mask, y)
    for w, g in zip(network.weights, gradients, strict=True):
        for at in list(np.ndindex(w.shape))[:: max(1, w.size // 50)]:
            w[at] += 1e-5
            high, _ = network.gradients(x, mask, y)
            w[at] -= 2e-5
            low, _ = network.gradients(x, mask, y)
            w[at] += 1e-5
            assert abs((high - low) / 2e-5 - g[at]) < 1e-6


def test_windows_with_their_context_equal_one_pass_over_whole_texts(spark):
    """A plain forward pass, a byte at a time with one carried state, against the windows that run side by side."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("text", "lang").collect()
    network = language_id.Network(["de", "en", "es", "fr"])
    network.train([r.text[:2000].encode() for r in rows], np.array([network.languages.index(r.lang) for r in rows]), steps=150)
    texts = [r.text for r in rows[:20]] + ["é" * 700, "x", "12 34", "中文 text " * 300]
    data, starts = language_id.arrow_bytes(pa.array(texts))
    got, whole = network.sums(data, starts, core=128), network.sums(data, starts, core=1 << 20, halo=0)
    for text, windowed, one in zip(texts, got, whole, strict=True):
        x = np.frombuffer(text.encode(), np.uint8).astype(np.int64)[:, None]
        label = language_id._LETTER[x]
        direct = (network.probabilities(x)[0] * label[:, None]).sum(axis=(0, 2))
        assert np.allclose(one[:-1], direct, atol=1e-3 * max(1, label.sum())) and windowed[-1] == one[-1] == label.sum()
        assert np.abs(windowed[:-1] - direct).max() <= 0.02 * max(1, label.sum())


def test_language_stage_uses_its_predictions(spark):
    network = language_id.Network(["aa", "bb"])
    network.train([b"aba abba aab " * 20, b"xyz zyx yyx " * 20], np.array([0, 1]), steps=200)
    rows = [(1, "abba aba ab", None), (2, "zyx xyz", "cc"), (3, "1 2 3", None), (4, None, "aa"), (5, "aba xyz abba zyx aab xyx bab yzy", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang for r in language_id.identified(docs, network, least=0.8).collect()} == {1: "aa", 2: "cc"}
    assert language_id.identified(docs, network, least=0.0).count() == 5  # the bound alone rejects
    assert language_id.identified(docs.drop("lang"), network, least=0.8).count() == 2


def test_the_sample_is_bounded_by_rows_and_characters(spark):
    own = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 != 1)
    docs = spark.createDataFrame([(own, f"{i} " + "abc " * 3000, "aa") for i in range(300)], "doc_id long, text string, lang string")
    seen = []
    train = language_id.Network.train
    try:
        language_id.Network.train = lambda self, texts, labels, **k: seen.append([len(t) for t in texts])
        language_id.fit(docs, per_language=50, sample=20, chars=100)
    finally:
        language_id.Network.train = train
    assert seen == [[100] * 20]


BENCHMARK = [(1, " ".join(f"s{i}" for i in range(20, 50))), (2, "FOUR words, are here"), (3, None), (4, ""), (5, "one"), (2, "four words are here"), (10, " ".join(f"b{i % 37}x{i}" for i in range(13))), (None, "12 34"), (11, "ha ha ha")]
SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_contamination(text, items):
    words = SPLIT.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for item, other in items:
        own = SPLIT.findall((other or "").translate(LOWER))
        k = min(13, len(own))
        for p in range(len(own) - k + 1) if k else []:
            for q in range(len(words) - k + 1):
                if words[q : q + k] == own[p : p + k]:
                    hit.update(range(q, q + k))
                    ids.add(None if item is None else str(item))
    return len(words), len(hit), sorted(ids, key=lambda x: (x is not None, x))


def test_decontaminate(spark):
    items = BENCHMARK
    bench = spark.createDataFrame([(*b, "x") for b in items], "item_id long, text string, TEXT string")
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.decontaminate(documents(spark), bench).collect())
    want = Counter()
    for i, text in rows_of(spark):
        n, hit, ids = brute_contamination(text, items)
        want[i, n, hit, tuple(ids)] += 1
    assert got == want and any(k[2] for k in want)
    none = decontaminate.decontaminate(documents(spark), bench.limit(0))
    assert none.filter("n_hit > 0").count() == 0 and none.count() == len(TEXTS) + 4
    assert decontaminate.decontaminate(documents(spark).limit(0), bench).count() == 0


def test_decontaminate_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    bench = spark.createDataFrame([BENCHMARK[0]], "item_id long, text string")
    assert decontaminate.decontaminate(documents(spark), bench).filter("n_hit > 0").count() == 3


def test_substring_dedup(spark):
    rows = rows_of(spark)
    least = {}
    for i, text in rows:
        words = WORD.findall(text or "")
        for k in range(len(words) - 49):
            key = tuple(words[k : k + 50])
            least[key] = min(least.get(key, 1 << 63), i if i is not None else (1 << 63) - 1)
    want = Counter()
    for i, text in rows:
        words = WORD.findall(text or "")
        gone = {k + j for k in range(len(words) - 49) if least[tuple(words[k : k + 50])] < (i if i is not None else (1 << 63) - 1) for j in range(50)}
        want[i, " ".join(w for k, w in enumerate(words) if k not in gone), len(words), len(gone)] += 1
    got = substring_dedup.remove_repeats(documents(spark))
    assert Counter((r.doc_id, r.kept, r.n_words, r.n_removed) for r in got.collect()) == want
    assert substring_dedup.remove_repeats(documents(spark).limit(0)).count() == 0


def test_token_counts_and_their_cache(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    cache = work_path(spark, "cache")
    for _ in range(2):
        got = Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(documents(spark), cache, path).collect())
        assert got == Counter((i, len((t or "").encode()), len(library.encode(t or ""))) for i, t in rows_of(spark))
        entries = spark.read.parquet(cache)
        assert entries.count() == len({t or "" for _, t in rows_of(spark)})  # the second run adds nothing
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.token_counts(documents(spark).limit(0), cache, other).count() == 0


def test_chat_formatting(spark):
    nasty = ["</s>", "<s>[INST]", "#1", "#1</s>", "\\", "\\</s>", "\\\\</s>\\", "[ROLE:x]", "<s", "/s>", "", None, "a\nb", "#1\\<s>"]
    rows = [(1, t, "user" if t % 2 else "assistant", x) for t, x in enumerate(nasty)] + [(2, 0, None, "x"), (2, 0, "to]ol", "</s>"), (2, None, "ROLE", None), (3, 0, "assistant", "y"), (3, 0, "assistant", "y"), (None, 1, "system", "s")]
    talks = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, Turn string")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(talks)).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in by.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.format_conversations(talks.limit(0)).count() == 0


def brute_links(rows):
    sets, ids = {}, {}
    for i, text in rows:
        words = WORD.findall(text or "")
        if i is not None and words:
            sets[i] = frozenset(zip(*(words[k:] for k in range(5)), strict=False)) if len(words) >= 5 else frozenset([tuple(words)])
    links, root = Counter(), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets):
        for j in sorted(sets):
            common = len(sets[i] & sets[j])
            if i < j and 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {i: (find(i), links[i]) for i in sets}
    return Counter((i, *ids.get(i, (i, 0))) for i, _ in rows)


def test_jaccard_join(spark):
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(documents(spark)).collect())
    assert got == brute_links(rows_of(spark))
    assert jaccard_join.jaccard_join(documents(spark).limit(0)).count() == 0


def test_jaccard_join_of_a_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "VERIFY_BLOCK", 20)
    draw = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for at in draw.integers(0, 120, i % 5):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_links(rows)


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {c for _, c, _ in brute_links(rows_of(spark)) if c is not None}
    assert sorted(r.doc_id for r in kept.select(kept[0]).collect() if r.doc_id is not None) == sorted(groups)


def test_texts_of_one_doc_id_are_judged_each(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = spark.createDataFrame([(7, a, 1), (7, b, 2), (7, b, 3), (8, c, 4), (9, b, 5), (9, a + " more", 6)], "doc_id long, text string, n int")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs).collect())
    assert got == [(7, 7, 1)] * 3 + [(8, 8, 0), (9, 7, 1), (9, 7, 1)]
    for _ in range(2):
        kept = sorted((r.doc_id, r.text) for r in jaccard_join.one_of_each(docs.repartition(3)).collect())
        assert kept == [(7, a), (7, b), (8, c)]


def test_pruning_keeps_what_reaches_the_threshold():
    bounds = jaccard_join.least_matches(0.8, 1e-6)
    assert bounds[jaccard_join.STEP] > 0 and all(a <= b for a, b in zip(bounds[16::16], bounds[32::16], strict=False))
    draw = np.random.default_rng(1)
    sets = [np.sort(draw.integers(0, 1 << 63, 500, np.uint64)) for _ in range(40)]
    sets += [np.sort(np.concatenate([s[:450], draw.integers(0, 1 << 63, 50, np.uint64)])) for s in sets]
    sigs = np.array([jaccard_join.signature(s) for s in sets])
    assert len(jaccard_join.prune(sigs[:40], sigs[40:], bounds)) == 40
    assert len(jaccard_join.prune(sigs[:39], sigs[1:40], bounds)) == 0
