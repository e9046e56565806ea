"""Each operator against a plain version, on rows that are awkward on purpose."""

import base64
import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import samples  # noqa: E402

from tidemark.llm import (  # noqa: E402
    bytepair, components, compression, curriculum, language, minhash, preferences, sanitise,
    simhash, toxicity, warc,
)

ROWS = samples.documents()
SPACE = "[^\\x20\\x09-\\x0D]+"


@pytest.fixture(scope="module")
def docs(spark):
    return samples.table(spark, clashes=True).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return samples.table(spark, [])


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- SimHash -------------------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w.encode() for w in re.findall(SPACE, re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    values = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints):
    """Component of each position, by comparing all pairs."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                root[top(i)] = top(j)
    return [top(i) for i in range(len(prints))]


def test_simhash_equals_all_pairs(docs):
    prints = [plain_fingerprint(r[1]) for r in ROWS]
    group = plain_components(prints)
    least = defaultdict(list)
    for row, g in zip(ROWS, group):
        if row[0] is not None:
            least[g].append(row[0])
    expected = sorted(((r[0], f"{p:016x}", min(least[g], default=None))
                       for r, p, g in zip(ROWS, prints, group)), key=repr)
    assert found(simhash.near_duplicates(docs)) == expected


def test_simhash_blocks_of_a_crowded_key_lose_no_link(spark):
    rng = np.random.default_rng(3)
    center = rng.integers(0, 1 << 62, 4)
    near = {int(c) ^ sum(1 << int(b) for b in rng.choice(62, rng.integers(0, 6), False))
            for c in center for _ in range(120)}
    near |= {int(v) for v in rng.integers(0, 1 << 62, 200)}
    points = sorted(near)
    distinct = spark.createDataFrame([(p, p) for p in points], "fp bigint, least bigint")
    links = simhash.links(distinct, block=16)
    assert all(bin(r.u ^ r.v).count("1") <= 3 for r in links.collect())
    got = {r.node: r.root for r in components.components(links).collect()}
    group = plain_components(points)
    ours = [got.get(p, p) for p in points]
    assert len(set(zip(ours, group))) == len(set(ours)) == len(set(group))


@pytest.mark.parametrize("n", [10, 10 ** 6, 10 ** 9, 10 ** 12])
def test_thresholds_keep_the_pigeonhole_sum(n):
    sample = np.random.default_rng(0).integers(0, 1 << 63, 500).astype(np.uint64)
    probes = simhash.plan_probes(sample, n)
    # Parts that are not probed count -1 each; bits are dealt once.
    bits = [b for p in probes for b in p.bits]
    assert len(bits) == len(set(bits))
    spare = 64 - len(bits)
    width = len(probes[0].bits)
    parts = len(probes) + round(spare / width)
    assert sum(p.threshold for p in probes) - (parts - len(probes)) == 3 - parts + 1


def test_one_document_of_each_group_stays(docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = simhash.classes(docs).select("root", "component_id").distinct().collect()
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.component_id for r in classes)


# --- language ------------------------------------------------------------------------------

def plain_phrases(text, sample):
    """Greedy longest matches, cut at segments as the operator cuts them."""
    count = 0
    for lo in range(0, len(text), language.SEGMENT):
        segment, at = text[lo:lo + language.SEGMENT], 0
        while at < len(segment):
            size = 1
            while at + size <= len(segment) and bytes(segment[at:at + size]) in sample:
                size += 1
            size = max(1, size - 1)
            if at + size < len(segment) or bytes(segment[at:at + 1]) not in sample:
                count += 1
            at += size
    return count


def test_phrases_are_longest_matches():
    model = language.LanguageModel({
        lang: [samples.prose(lang, 40, i) for i in range(30)] for lang in ("en", "fr")}).build()
    texts = [samples.prose("en", 500, 1), "éé zzz qqq the of", "", "x" * 3000, "le la 中文 de"]
    codes = [model._squeeze(t) for t in texts]
    got = model.phrases(codes)
    for i, name in enumerate(model.names):
        pieces = model.samples[name]
        sample = bytes(np.concatenate([model._squeeze(p) for p in pieces])[:language.SAMPLE_CHARS]
                       .astype(np.uint8))
        for k, code in enumerate(codes):
            code = code.astype(np.uint8)
            # The last phrase of a segment ends with it and is not counted.
            whole = plain_phrases(code, sample)
            assert abs(int(got[k, i]) - whole) <= 1 + len(code) // language.SEGMENT, (k, name)


def test_language_of_awkward_rows(docs, empty):
    model = language.train(language.held_out(docs))
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()}
    assert all((i, "und") in got for i in (200, 201, 202, 203))
    truth = {r[0]: r[2] for r in ROWS if r[0] is not None and r[0] < 60 and r[0] != 7}
    hits = sum((i, lang) in got for i, lang in truth.items())
    assert hits >= 0.97 * len(truth)
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty, model).count() == 0
    kept = language.reject_unknown(docs, model)
    assert kept.columns == docs.columns
    assert not {200, 201, 202, 203} & {r.doc_id for r in kept.collect()}


def test_held_out_language_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(language.held_out(docs))
    rows = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


# --- personal data -------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in
                    enumerate(digits[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(11)
    pieces = ["a.b@c.d", "x@y", "@", "..", "a@b.c@d.e", "1.2.3.4", "1.2.3.4.5.6.7.8", "999.1.1.1",
              "0001.2.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "5", "-", " ", "\n",
              "+1 (555) 010-9999", "+49.30.1234567", "+", "(", "é", "😀", "user%x+y@m-1.example.com",
              "12345678901234567890", "a@b-.c", "٣٤", "a@b..c", "@a.b", "+1234567890123456"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces, rng.integers(0, 12)))
        assert sanitise.base_spans(text) == plain_spans(text), repr(text)


def test_spans_of_awkward_rows(docs, empty):
    got = found(sanitise.spans(docs).select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                                            "base_sha256"))
    expected = []
    for row in ROWS:
        spans = plain_spans(row[1])
        kinds = Counter(s[0] for s in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((row[0], *(kinds[k] for k in sanitise.KINDS),
                         hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(expected, key=repr)
    assert sanitise.spans(empty).count() == 0


def test_terms_that_reveal_an_entity_go(spark):
    rows = [(i, f"Line {samples.prose('en', 12, i)}\ncontact Zebulon {samples.prose('en', 5, i)} "
             "the zed@corp.example.com now", "en", "s", 0) for i in range(6)]
    rows += [(100 + i, samples.prose("en", 60, 100 + i) + " contact", "en", "s", 0)
             for i in range(40)]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    out = {r.doc_id: r.spans for r in sanitise.spans(docs).collect()}
    for i, text, *_ in rows[:6]:
        at = text.index("Zebulon")
        assert f"removed:{at}:{at + 7}" in out[i]
        assert f":{text.index(' the zed') + 1}:" not in out[i]
    assert not any(out[100 + i] for i in range(40))
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert "Zebulon" not in clean[0] and "[EMAIL]" in clean[0] and clean[100] == rows[6][1]


def test_a_revealing_term_goes_wherever_it_stands(spark):
    rows = [(i, f"Zebulon spoke {samples.prose('en', 30, i)}\n{samples.prose('en', 9, 50 + i)} Zebulon "
             f"zed@corp.example.com {samples.prose('en', 5, 70 + i)}", "en", "s", 0) for i in range(6)]
    rows += [(10, "Here zebulon stands alone. " + samples.prose("en", 30, 9), "en", "s", 0)]
    # One of the documents has been copied: both sides of the ratio count the copies.
    rows += [(1000 + i, rows[0][1], "en", "s", 0) for i in range(60)]
    rows += [(100 + i, samples.prose("en", 60, 100 + i), "en", "s", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    clean = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert not any("zebulon" in t.lower() for t in clean.values())
    assert all(clean[100 + i] == rows[67 + i][1] for i in range(400))
    # The disclosure, recomputed from whole documents.
    holders = {i for i, t, *_ in rows if "zed@corp" in t}
    having = {i for i, t, *_ in rows if "zebulon" in t.lower()}
    disclosure = 1 + np.log2(len(holders & having) / len(having)) / np.log2(len(rows) / len(holders))
    found = sanitise.find(docs)
    kinds = {r.term: r.kind for r in sanitise.revealing(found, docs).collect()}
    assert disclosure >= sanitise.REMOVE and kinds == {"zebulon": "removed"}
    kinds = {r.term: r.kind for r in sanitise.revealing(found, docs, remove=disclosure + 1e-9).collect()}
    assert kinds == {"zebulon": "generalised"}
    assert not sanitise.revealing(found, docs, remove=2.0, generalise=disclosure + 1e-9).count()


def test_many_entities_in_one_text_cost_in_proportion():
    import time
    text = "\n".join(f"at 10.{i % 250}.{i // 250 % 250}.{i // 62500} host alpha beta" for i in range(200_000))
    begun = time.process_time()
    spans = sanitise.base_spans(text)
    assert len(spans) == 200_000 and sum(1 for _ in sanitise.context(text, spans)) >= 600_000
    assert time.process_time() - begun < 60


def test_sanitised_rows_keep_columns(docs):
    out = sanitise.sanitised(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    row = out.filter("doc_id = 206").first()
    assert "[EMAIL]" in row.text and "4111" not in row.text and row.n_chars == len(row.text)


# --- byte pairs ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.tiktoken")
    return path, public.PATTERN, bytepair.BytePairs(bytepair.read_ranks(path), public.PATTERN)


def test_ids_equal_the_reference_tokenizer(spark, docs, empty, vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern, _ = vocabulary
    plain = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                              mergeable_ranks=bytepair.read_ranks(path))

    def digest(text):
        return hashlib.sha256(text).hexdigest()
    expected = []
    for row in ROWS:
        ids = plain.encode_ordinary(row[1] or "")
        expected.append((row[0], len(ids), digest(" ".join(map(str, ids)).encode()),
                         digest((row[1] or "").encode())))
    assert found(bytepair.encode_documents(docs, path, pattern)) == sorted(expected, key=repr)
    assert bytepair.encode_documents(empty, path, pattern).count() == 0
    assert bytepair.encode_ids(docs, path, pattern).count() == len(ROWS)


def test_white_space_and_scripts(vocabulary):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern, ours = vocabulary
    plain = tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                              mergeable_ranks=bytepair.read_ranks(path))
    rng = np.random.default_rng(5)
    alphabet = list("ab  \n\t\r\x0b\x1c\x85\xa0 　'sdlvre 09²éß中文🙂-=_.!?́ª") + [
        "the ", "  ", "'ll"]
    for _ in range(5000):
        text = "".join(rng.choice(alphabet, rng.integers(0, 25)))
        assert ours.encode(text) == plain.encode_ordinary(text), repr(text)
        assert ours.decode_text(ours.encode_text(text)).decode() == text
    assert ours.encode("x" * 20_000) == plain.encode_ordinary("x" * 20_000)


def test_edits_equal_a_new_encoding_and_reuse_prefixes(vocabulary):
    _, _, ours = vocabulary
    rng = np.random.default_rng(2)
    parts = ["the", "ly", "  ", "don't", "42", "ion.", "\n\n", "é", "%$", " "]
    for _ in range(400):
        text = bytepair.EditableText(ours, " ".join(rng.choice(parts, rng.integers(0, 12))))
        for _ in range(3):
            start = int(rng.integers(0, len(text.text) + 1))
            end = int(rng.integers(start, min(len(text.text), start + 6) + 1))
            text.replace(start, end, str(rng.choice(parts)))
            assert text.ids() == ours.encode(text.text)
    long = bytepair.EditableText(ours, samples.prose("en", 3000, 1))
    before = long.encoded
    long.replace(5000, 5002, "zz")
    long.append(" end")
    assert long.encoded - before < 20 and long.ids() == ours.encode(long.text)


# --- quality -------------------------------------------------------------------------------

def plain_quality(text):
    text = text or ""
    words = re.findall(SPACE, text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3)
               if windows[tuple(words[i:i + 3])] > 1}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup,
            len(covered), failed)


def test_base_quality_equals_plain_counts(docs, empty):
    rows = compression.quality(docs).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in rows), key=repr)
    assert got == sorted(((r[0], *plain_quality(r[1])) for r in ROWS), key=repr)
    assert not any(r.kept for r in rows if r.base_failed)
    assert compression.quality(empty).count() == 0


def test_the_end_of_a_text_is_judged():
    import zstandard
    compress = zstandard.ZstdCompressor(level=compression.LEVEL).compress
    prose = samples.prose("en", 2000, 1).encode()[:compression.CHUNK]
    tail = b"aaaa " * 700  # less than a chunk
    assert compression.measure(prose, compress)[1:3] == (1, 0)
    assert compression.measure(prose + prose[:500], compress)[1:3] == (1, 0)
    noise = np.random.default_rng(1).bytes(compression.CHUNK - 1)
    assert compression.measure(noise[:2000] * 2 + b"x" * 96 + noise, compress)[1] == 1
    whole = len(compress(prose + tail)) / len(prose + tail)
    ratio, chunks, outside, _ = compression.measure(prose + tail, compress)
    low, high = compression.CHUNK_BAND
    assert chunks == 1 and ratio == whole and outside == (not low <= whole <= high)


def test_quality_of_odd_texts():
    import zstandard
    compress = zstandard.ZstdCompressor(level=3).compress
    texts = ["a\x0bb \x0cc\rd\x1fe\x85f", "x\ny\nx\n \nx\n", "a b c a b c a", "a b c d b c a b c"]
    for text in texts:
        r = compression.judge(text, compress)
        assert tuple(r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                    "n_repeat_words", "base_failed")) == plain_quality(text)
    clean = samples.prose("en", 600, 4)
    assert compression.judge(clean, compress)["kept"]
    rng = np.random.default_rng(0)
    noise = " ".join(base64.b64encode(rng.bytes(45)).decode() for _ in range(400))
    assert not compression.judge(noise, compress)["kept"]
    stutter = " ".join(f"word{i % 9}x" for i in range(4000))
    assert not compression.measure(stutter.encode(), compress)[3]
    half = clean + " " + stutter + " " + stutter
    assert not compression.measure(half.encode(), compress)[3]


# --- MinHash -------------------------------------------------------------------------------

def test_minhash_neighbours(docs, empty):
    rows = minhash.neighbours(docs).collect()
    assert len(rows) == len(ROWS)
    by_text = defaultdict(set)
    text_of = {r[0]: r[1] or "" for r in ROWS}
    for r in rows:
        if r.doc_id not in (3, 7, None):
            by_text[text_of[r.doc_id]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    # Ids that are there once follow each other in descending order.
    sketcher = minhash.Sketcher()
    order = sorted({r[0] for r in ROWS if r[0] is not None}, reverse=True)
    got = {r.doc_id: r for r in rows}
    for one, two in zip(order, order[1:]):
        if {one, two} & {3, 7}:
            continue
        a, b = text_of[one], text_of[two]
        cut = len(a) // 3
        edited = a[:len(a) - cut] + b[:cut]
        row = got[one]
        assert row.n_chars == len(a)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sig = [sketcher.signature(t) for t in (a, edited, b)]
        assert [row.fingerprint, row.edited_fingerprint] == [minhash.written(s) for s in sig[:2]]
        assert row.near_edited == np.mean(sig[0] == sig[1])
        assert row.near_next == np.mean(sig[0] == sig[2])
    assert minhash.neighbours(empty).count() == 0


def test_last_document_is_followed_by_the_first(spark):
    rows = [(i, samples.prose("en", 30, i), "en", "s", 0) for i in (4, 9, 2)]
    text = {r[0]: r[1] for r in rows}
    for ranges in (1, 2, 50):
        pairs = {(r.range, r.extra, r.doc_id, r.text)
                 for r in minhash.successors(spark.createDataFrame(rows, samples.SCHEMA),
                                             ranges).collect()}
        assert sum(not p[1] for p in pairs) == 3
    out = {r.doc_id: r.edited_sha256
           for r in minhash.neighbours(spark.createDataFrame(rows, samples.SCHEMA)).collect()}
    for one, two in ((9, 4), (4, 2), (2, 9)):
        edited = minhash.edit(text[one], text[two])
        assert out[one] == hashlib.sha256(edited.encode()).hexdigest()


def test_signatures_estimate_jaccard():
    sketcher = minhash.Sketcher()
    for overlap in (0, 300, 700, 950):
        words = [f"w{i}" for i in range(2000 - overlap)]
        a, b = words[:1000], words[1000 - overlap:]
        one, two = (" ".join(x) for x in (a, b))
        sets = [{tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (a, b)]
        truth = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        guess = np.mean(sketcher.signature(one) == sketcher.signature(two))
        assert abs(guess - truth) < 0.15


def test_similar_pairs_are_verified(docs):
    members, pairs = minhash.similar(docs)
    classes = {r.doc_id: r.class_id for r in members.collect()}
    assert {classes[100 + i] for i in range(8)} == {100}
    got = {(r.left_id, r.right_id): r.similarity for r in pairs.collect()}

    def shingles(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    near = [100, *range(120, 125)]
    texts = {r[0]: r[1] for r in ROWS}
    for i, a in enumerate(near):
        for b in near[i + 1:]:
            x, y = shingles(texts[a]), shingles(texts[b])
            assert got[a, b] == pytest.approx(len(x & y) / len(x | y))
    assert all(v >= 0.8 for v in got.values())


# --- mixing --------------------------------------------------------------------------------

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=str) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**target, **share}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        free -= over


def test_mix_meets_targets(docs, empty):
    size = lambda t: len(re.findall(SPACE, t or ""))
    sizes = defaultdict(int)
    for r in ROWS:
        sizes[r[3]] += size(r[1])
    targets = plain_targets(dict(sizes))
    rows = curriculum.mixture(docs).collect()
    assert sorted((repr(r.doc_id), r.size) for r in rows) == sorted(
        (repr(r[0]), size(r[1])) for r in ROWS)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == r.times * r.size <= 3 * r.size and len(r.positions) == r.times
        taken[r.source] += r.taken
    for s, t in targets.items():
        largest = max((size(r[1]) for r in ROWS if r[3] == s), default=0)
        assert abs(taken[s] - t) <= largest / 2 + 1
    again = curriculum.mixture(docs).collect()
    assert found_rows(rows) == found_rows(again)
    assert [r.position for r in rows if r.position is not None] == sorted(
        r.position for r in rows if r.position is not None)
    assert curriculum.mixture(empty).count() == 0


def found_rows(rows):
    return sorted(map(tuple, rows), key=repr)


def test_sources_without_words(spark):
    rows = [(1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "x y z", "en", "b", 5)]
    docs = spark.createDataFrame(rows, samples.SCHEMA)
    got = {r.doc_id: r for r in curriculum.mixture(docs).collect()}
    assert got[1].target == 0 and got[1].taken == 0 and got[1].position is None
    assert got[3].target == 3 and got[3].taken == 3
    assert [r.doc_id for r in curriculum.mixed_documents(docs).collect()] == [3]
    none = curriculum.mixture(docs.filter("doc_id < 3")).collect()
    assert [r.taken for r in none] == [0, 0]


def test_targets_share_what_is_over(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, "d": 400, "e": 0, None: 30}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r.source: r.target for r in curriculum.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


@pytest.mark.parametrize("schedule", curriculum.SCHEDULES)
def test_positions_invert_the_integrated_schedule(spark, schedule):
    shares = np.linspace(0, 1, 21)
    df = spark.createDataFrame([(float(s),) for s in shares], "s double")
    got = [r[0] for r in df.orderBy("s").select(
        curriculum.when_demanded(F.col("s"), schedule)).collect()]
    grid = np.linspace(0, 1, 200_001)
    weight = np.interp(grid, *zip(*schedule))
    demand = np.concatenate(([0], np.cumsum((weight[1:] + weight[:-1]) / 2)))
    assert got == pytest.approx(np.interp(shares, demand / demand[-1], grid), abs=1e-4)


def test_mixed_documents_repeat_whole_rows(docs):
    out = curriculum.mixed_documents(docs)
    assert out.columns == docs.columns
    times = Counter()
    for r in curriculum.plan(docs).collect():
        times[r.doc_id] += r.times
    assert Counter(r.doc_id for r in out.collect()) == +times


# --- WARC ----------------------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, bundle string, sha string"


def pages():
    rows = [(i, f"http://h{i}/é\n", f"<p>{i % 7}</p>" * (1 + i % 5)) for i in range(50)]
    rows += [(60, None, None), (61, "u", ""), (None, "n", "<p>x</p>"), (None, "m", "<p>x</p>"),
             (62, "u", "<b>" * 300_000), (63, "a", "same"), (63, "b", "same"), (5, "c", "same")]
    return [(*r, "x", "y") for r in rows]


def test_bundles_give_every_page_back(spark):
    df = spark.createDataFrame(pages(), PAGES).repartition(3)
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "bundles")
    index = warc.write_bundles(df, folder)
    rows = warc.read_bundles(index, folder).collect()
    groups = defaultdict(list)
    for p, _, html, *_ in pages():
        groups[html or ""].append(p)
    expected = []
    for html, ids in groups.items():
        ids.sort(key=lambda p: (p is not None, p), reverse=True)
        digest = warc.payload_digest(html.encode())
        for k, p in enumerate(ids):
            again = len(ids) > 1 and k > 0
            expected.append((p, len(html.encode()), digest, "revisit" if again else "response",
                             ids[0] if again else None))
    assert found_rows(rows) == sorted(expected, key=repr)
    # One record at a time, through frame and offset.
    payload = {r.page_id: r.block for r in warc.fetch(index, folder).collect()}
    assert payload[62].endswith(b"<b>" * 300_000)
    assert index.select("record_id").distinct().count() == len(pages())
    assert warc.archive(df.limit(0)).count() == 0


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame(pages(), PAGES)
    rows = warc.archive(df, least=20).collect()
    assert all(r.record_type == "response" for r in rows if r.payload_bytes < 20)
    assert any(r.record_type == "revisit" for r in rows)


def test_frames_stand_alone(tmp_path):
    import zstandard
    from pyarrow import fs
    store = fs.LocalFileSystem()
    writer = warc.BundleWriter(store, str(tmp_path / "a.warc.zst"))
    places = [writer.add(warc.record(i, "http://x", b"p" * (i * 999), "D", 0)) for i in range(200)]
    writer.close()
    reader = warc.BundleReader(store, writer.path)
    assert len(reader.places) > 10
    for i in (0, 77, 199):
        headers, block = reader.record(places[i][0], places[i][1])
        assert headers["WARC-Page-ID"] == str(i) and block.endswith(b"p" * (i * 999))
    whole = b"".join(reader.frame(k) for k in range(len(reader.places)))
    with open(writer.path, "rb") as f:  # any reader skips the seek table
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == whole


# --- preferences ---------------------------------------------------------------------------

TURNS = "pair_id bigint, turn bigint, role string, text string, part string"


def test_prefix_is_rendered_once(spark):
    chosen = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "good"),
              (2, 0, "user", "only"), (3, 0, "user", "a"), (3, 1, "assistant", None),
              (4, 0, "user", "same"), (None, 0, "user", "x"), (5, 0, None, "r")]
    rejected = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"),
                (1, 3, "user", "why"), (3, 0, "user", "b"), (3, 1, "assistant", None),
                (4, 0, "user", "same"), (5, 0, "user", "r"), (5, 0, "user", "r")]
    made = [preferences.turns(spark.createDataFrame([(*r, "z") for r in rows], TURNS), "pair_id")
            for rows in (chosen, rejected)]
    rows = preferences.format_preferences(*made).collect()
    got = sorted((r.pair_id, r.part, r.turn, r.nth, r.segment[r.mask_from:r.mask_to]
                  if r.mask_from is not None else None) for r in rows)
    end = "<|im_end|>\n"
    assert got == sorted([
        (1, "prompt", 0, 1, None), (1, "prompt", 1, 1, None), (1, "chosen", 2, 1, "good" + end),
        (1, "rejected", 2, 1, "bad" + end), (1, "rejected", 3, 1, None),
        (2, "chosen", 0, 1, None), (3, "chosen", 0, 1, None), (3, "rejected", 0, 1, None),
        (3, "chosen", 1, 1, end), (3, "rejected", 1, 1, end), (4, "prompt", 0, 1, None),
        (5, "prompt", 0, 1, None), (5, "rejected", 0, 2, None)])
    assert preferences.format_preferences(made[0].limit(0), made[1].limit(0)).count() == 0


def plain_preferences(rows):
    """(pair_id, part, turn, nth, role, text) of all turns, by plain loops."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None and turn is not None:
            convs.setdefault(conv, []).append((turn, role or "user", text or ""))
    for conv, said in convs.items():
        seen = Counter()
        convs[conv] = []
        for turn, role, text in sorted(said):
            seen[turn] += 1
            convs[conv].append((turn, seen[turn], role, text))
    answered = sorted(c for c, said in convs.items() if any(r == "assistant" for _, _, r, _ in said))
    out = []
    for conv, said in convs.items():
        other = said
        if conv in answered:
            rank = answered.index(conv)
            which = 0 if rank % 2 == 0 else -1
            cut, start = ([r[:2] for r in convs[c] if r[2] == "assistant"][which]
                          for c in (conv, answered[(rank + 1) % len(answered)]))
            source = convs[answered[(rank + 1) % len(answered)]]
            other = [r for r in said if r[:2] < cut] + [
                (t - start[0] + cut[0], n - start[1] + cut[1] if t == start[0] else n, role, text)
                for t, n, role, text in source if (t, n) >= start]
        places = sorted({r[:2] for r in said} | {r[:2] for r in other})
        at = {r[:2]: r[2:] for r in said}, {r[:2]: r[2:] for r in other}
        parting = next((p for p in places if at[0].get(p) != at[1].get(p)), (float("inf"), 0))
        out += [(conv, "prompt" if r[:2] < parting else "chosen", *r) for r in said]
        out += [(conv, "rejected", *r) for r in other if r[:2] >= parting]
    return sorted(out)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("convs", [0, 1, 2, 9])
def test_every_turn_of_every_conversation_is_there(spark, convs):
    rng = np.random.default_rng(convs)
    rows = []
    for c in range(convs):  # sparse ids and turn numbers, later turns, repeated and null ones
        turns = sorted(rng.choice(1000, int(rng.integers(1, 9)), replace=False).tolist())
        rows += [(c * 7919 + 12, t, ["user", "assistant", None, "system"][int(rng.integers(4))],
                  ["yes", "no", None, "é" * 300_000][int(rng.integers(4))]) for t in turns]
    if convs == 9:
        rows += [(3, 5, "user", "only asks"), (3, 6, "user", "again"), (None, 1, "user", "x"),
                 (4, None, "assistant", "x"), (5, 1, "assistant", "a"), (5, 1, "assistant", "a"),
                 (5, 1, "assistant", "b"), (5, 9, "user", "thanks")]
    table = spark.createDataFrame(rows, CONVERSATIONS).select("*", *[
        F.lit(None).cast("string").alias(c) for c in ("pair_id", "nth", "rank", "source", "its", "said0")])
    got = sorted((r.pair_id, r.part, r.turn, r.nth, r.role,
                  r.segment[len(f"<|im_start|>{r.role}\n"):-len("<|im_end|>\n")])
                 for r in preferences.format_preferences(
                     *preferences.answers_exchanged(table)).collect())
    assert got == plain_preferences(rows)
    kept = sum(r[0] is not None and r[1] is not None for r in rows)
    assert sum(r[1] != "rejected" for r in got) == kept


# --- toxicity ------------------------------------------------------------------------------

def toxic_rows(n=240):
    rows, labels = [], []
    for i in range(n):
        lang = ("en", "fr")[i % 2]
        text, bad = samples.prose(lang, 40, 10_000 + i), i % 3 == 0
        if bad:
            words = text.split()
            words.insert(i % 30, ("scumbag", "vequ" + "abcdefgh"[i % 8] * 3)[i % 2])
            text = " ".join(words)
        rows.append((i, text, lang, "s", len(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, docs, empty):
    rows, labels = toxic_rows()
    table = spark.createDataFrame(rows, samples.SCHEMA)
    known = spark.createDataFrame([*labels, (None, 1, 1), (9999, 1, None)],
                                  "doc_id bigint, quality int, toxic int")
    model = toxicity.train(toxicity.sample(table, toxicity.learnable(known)))
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    out = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].predicted == labels[i][2] for i in out]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    awkward = toxicity.score(docs, model).collect()
    assert len(awkward) == len(ROWS)
    assert all(r.predicted == 0 for r in awkward if r.doc_id in (200, 201, 202))
    assert toxicity.score(empty, model).count() == 0
    blank = toxicity.train(toxicity.sample(empty, known.limit(0)))
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.0}


def test_learning_reads_whole_texts(spark):
    rows = [(i, "calm " * (4000 if i < 4 else 20) + "end" + str(i), "en", "s", 0) for i in range(8)]
    rows.append((8, "x" * 300_000, "en", "s", 0))
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)], "doc_id bigint, toxic int")
    drawn = toxicity.sample(samples.table(spark, rows), labels)
    assert sorted(t[-4:] for t, _, _ in drawn) == [f"end{i}" for i in range(8)]  # the longest is not drawn
    assert sum(len(t) > 12_000 for t, _, _ in drawn) == 4


def test_forward_pass_equals_plain_loops():
    rng = np.random.default_rng(3)
    model = toxicity.Toxicity(np.zeros((4, toxicity.WIDTH), np.float32))
    model.filters = {w: rng.normal(size=(w, toxicity.WIDTH, toxicity.FILTERS)).astype(np.float32)
                     for w in toxicity.WIDTHS}
    model.offset = {w: rng.normal(size=toxicity.FILTERS).astype(np.float32) for w in toxicity.WIDTHS}
    model.layer = rng.normal(size=toxicity.FILTERS * len(toxicity.WIDTHS))
    model.bias = 0.3
    counts = np.array([5, 0, 1, 2, 7])
    words = rng.normal(size=(counts.sum(), toxicity.WIDTH)).astype(np.float32)
    got, at = model.logits(words, counts), 0
    for n, logit in zip(counts, got):
        text, at = words[at:at + n], at + n
        pooled = []
        for w in toxicity.WIDTHS:
            for f in range(toxicity.FILTERS):
                answers = [model.offset[w][f] + sum(  # past the end a filter sees nothing
                    text[i + k] @ model.filters[w][k][:, f] for k in range(w) if i + k < n)
                    for i in range(n)]
                pooled.append(max(answers, default=-4.0))
        assert np.isclose(logit, np.tanh(pooled) @ model.layer + 0.3, atol=1e-4)


def test_training_repeats():
    rows, labels = toxic_rows(120)
    pairs = [(r[1], r[2], lab[2]) for r, lab in zip(rows, labels)]
    one, two = toxicity.train(pairs), toxicity.train(pairs)
    assert np.array_equal(one.embed, two.embed) and np.array_equal(one.thresholds, two.thresholds)


def test_pooling_sees_each_text_alone():
    rows, labels = toxic_rows(120)
    model = toxicity.train([(r[1], r[2], lab[2]) for r, lab in zip(rows, labels)])
    texts = [r[1] for r in rows] + ["", "one", " ", samples.prose("en", 70_000, 1)]
    together = toxicity.Scorer(model).score(texts)
    alone = [toxicity.Scorer(model).score([t])[0] for t in texts]
    assert together == pytest.approx(alone, abs=1e-4)
