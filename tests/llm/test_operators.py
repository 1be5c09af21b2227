"""The corpus operators against SQL, brute force and round trips, with nulls, empty and long texts, ties and clashing names."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from parity import compare, tables
from quire.llm import chat, decontaminate, media, mixing, near_dedup, quality, queries, substring_dedup, suffix_dedup, token_counts, token_output
from quire.llm.hashing import super_min_hash

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, kept string, component_id string, n_words string, term string, block string, found string, words string"
EMPTY = hashlib.sha256(b"").hexdigest()


def docs_of(spark, texts, langs=None):
    rows = [(k, t, langs[k] if langs else "en", None if (k or 0) % 2 else "src1", "x", "y", "z", "t", "b", "f", "w") for k, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, repeats, one very long text, other scripts and control strings."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = " ".join(rng.choice(words) for _ in range(300))
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (6, base.replace("w1 ", "v1 ", 2)), (7, "one"), (8, "One two"), (9, " ".join(rng.choice(words) for _ in range(60_000)))]
    texts += [(10, "日本語 テキスト é é İ Σς <|endoftext|> x  y   z "), (11, "same " * 200), (12, base[:400] + " tail of its own"), (13, "don't stop, it's 12 o'clock!!! a_b")]
    return texts


def full(odd):
    return [(k, t or "") for k, t in odd]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    _, wrong = compare(spark, tables(SF_DIR), SF_DIR, name)
    assert not wrong


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, name, tmp_path):
    for table in ("documents", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == (1 if name == "op4_chat" else 0)


def test_token_counts(spark, odd):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: (len(t.encode()), len(model.encode(t, add_special_tokens=False).ids)) for k, t in full(odd)}
    found = {r.doc_id: r for r in token_counts.token_counts(spark, docs_of(spark, odd)).collect()}
    assert {k: (r.n_bytes, r.n_tokens) for k, r in found.items()} == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in found.values())


def test_token_output(spark, odd):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, start = [], 0
    for k, t in sorted(full(odd)):
        ids = np.array([*model.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    manifest = token_output.write_tokens(spark, docs_of(spark, odd), length=64, rows=4)
    assert sorted(tuple(r) for r in token_output.read_tokens(manifest).collect()) == want
    row = manifest.where("n_tokens > 0").first()
    file = token_output.TokenFile(row.data)
    ids, mask = file.sequence(0)
    assert len(ids) == len(mask) == 64 and mask[0].as_py()


def test_chunks_are_cut_where_the_vocabulary_cuts(spark):
    model, rng = token_output.ChunkEncoder("byte_bpe_50k.json"), random.Random(1)
    texts = ["".join(rng.choice([" ", "  ", "\n", "\t", "a", "Bc", "'s", ",", ".", "12", "é", "<|endoftext|>", " ", "\x1c"]) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    ids, sizes = model.encode(pa.array(texts), 7)
    got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [[*x.ids, 7] for x in model.model.encode_batch(texts, add_special_tokens=False)]


def test_pre_tokens_are_cut_where_the_vocabulary_cuts():
    count, rng = token_counts.piece_counter("word_bpe_49k.json"), random.Random(2)
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["".join(rng.choice(["a", "Bc", "'s", "'", ",", "_", "%", "1", "é", "İ", "é", "<|endoftext|>", "ß", "'LL", "Σ"]) for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    got = [sum(count(token_counts.pre_tokens(t.encode()))) for t in texts]
    assert got == [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


def test_media(spark, odd):
    found = {r.doc_id: r for r in media.digest_media(media.to_media(docs_of(spark, odd))).collect()}
    for k, t in full(odd):
        raw = t.encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        r = found[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert found[4].media_sha256 == found[5].media_sha256 and found[4].feature == found[5].feature
    assert len(found[9].frames) > 1 and sum(sum(f.histogram) for f in found[9].frames) >= found[9].payload_bytes
    frames = media.decode_frames(media.to_media(docs_of(spark, [(1, "ab"), (None, "c"), (1, "d" * 70)]))).collect()
    assert [(f.doc_id, f.width, f.height, f.delay_ms) for f in frames] == [(1, 64, 1, 100), (None, 64, 1, 100), (1, 64, 2, 100)] and sum(frames[0].histogram) == 64
    assert media.digest_media(media.to_media(docs_of(spark, [(None, "c"), (None, "c"), (4, "c")]))).distinct().count() == 2


def lzw(pixels, bits):
    """A plain LZW encoder with growing codes."""
    clear, out, held, have = 1 << bits, bytearray(), 0, 0

    def put(code):
        nonlocal held, have
        held |= code << have
        have += size
        while have >= 8:
            out.append(held & 255)
            held, have = held >> 8, have - 8

    size, table = bits + 1, {bytes([k]): k for k in range(clear)}
    put(clear)
    now = b""
    for p in pixels:
        more = now + bytes([p])
        if more in table:
            now = more
            continue
        put(table[now])
        table[more] = len(table) + 2
        if len(table) + 2 > 1 << size and size < 12:
            size += 1
        if len(table) + 2 >= 4095:
            put(clear)
            size, table = bits + 1, {bytes([k]): k for k in range(clear)}
        now = bytes([p])
    put(table[now])
    put(clear + 1)
    out.append(held & 255)
    return bytes(out)


def gif(frames, width, high, palette):
    out = b"GIF89a" + width.to_bytes(2, "little") + high.to_bytes(2, "little") + bytes([0x80 | 1, 0, 0]) + bytes(palette)
    for pixels, (left, top, w, h), disposal, transparent in frames:
        out += b"\x21\xf9\x04" + bytes([disposal << 2 | (transparent is not None), 5, 0, transparent or 0, 0])
        out += b"\x2c" + b"".join(x.to_bytes(2, "little") for x in (left, top, w, h)) + b"\0" + bytes([2]) + media.sub_blocks(lzw(pixels, 2))
    return out + b";"


def test_gif_disposal_and_transparency():
    palette = [0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255]
    first = ([1] * 16, (0, 0, 4, 4), 1, None)
    second = ([2, 3, 3, 2], (1, 1, 2, 2), 3, 3)
    third = ([2] * 4, (0, 0, 2, 2), 2, None)
    fourth = ([3], (3, 3, 1, 1), 0, None)
    shown = [rgb for _, rgb in media.composed(gif([first, second, third, fourth], 4, 4, palette))]
    assert (shown[0] == [255, 0, 0]).all()
    assert shown[1][1, 1].tolist() == [0, 255, 0] and shown[1][1, 2].tolist() == [255, 0, 0]
    assert shown[2][2, 2].tolist() == [255, 0, 0] and shown[2][0, 0].tolist() == [0, 255, 0]
    assert shown[3][0, 0].tolist() == [0, 0, 0] and shown[3][3, 3].tolist() == [0, 0, 255]


def test_lzw_streams():
    rng = random.Random(4)
    for bits in (2, 4, 8):
        for size in (1, 50, 9000):
            pixels = [rng.randrange(1 << bits) if rng.random() < 0.3 else 1 for _ in range(size)]
            assert media.lzw_decode(lzw(pixels, bits), bits, size).tolist() == pixels
    for size in (64, 3000, 70_000):
        pixels = bytes(rng.choice(b"abc \xff\0") if rng.random() < 0.7 else rng.randrange(256) for _ in range(size))
        codes = media.lzw_codes(pixels)
        assert max(codes) > 257 and plain_lzw(media.pack_codes(codes)) == pixels
        assert size < 9999 or codes.count(256) > 1 and max(codes) > 2048


def plain_lzw(data):
    """A decoder of eight-bit streams, bit by bit."""
    bits, at, out = int.from_bytes(data, "little"), 0, b""
    table, size, last = [], 9, None
    while True:
        code, at = bits >> at & ((1 << size) - 1), at + size
        if code == 257:
            return out
        if code == 256:
            table, size, last = [bytes([k]) for k in range(256)] + [b"", b""], 9, None
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last is not None and len(table) < 4096:
            table.append(last + entry[:1])
            size = min(12, max(size, (len(table)).bit_length()))
        last = entry


def test_media_that_break_off():
    whole = media.encode_gif(bytes(range(64)) * 3000)
    assert len(list(media.composed(whole))) == 3
    assert list(media.composed(None)) == list(media.composed(b"")) == list(media.composed(b"PNG and more")) == []
    for cut in (7, 14, 800, len(whole) // 2, len(whole) - 1):
        frames = list(media.composed(whole[:cut]))
        assert len(frames) <= 3 and all(rgb.shape == (1024, 64, 3) for _, rgb in frames)
    assert media.lzw_decode(b"", 8, 5).tolist() == media.lzw_decode(b"\xff\xff\xff\xff", 8, 5).tolist() == [0] * 5
    for k in range(300):
        broken = bytearray(whole[:3000])
        random.Random(k).shuffle(broken[800:]) if k % 2 else broken.__setitem__(800 + 7 * k, k % 256)
        list(media.composed(bytes(broken)))


def test_chat(spark):
    rng, rows = random.Random(6), []
    parts = [*chat.CONTROLS, chat.ESCAPE, "<", "|turn|>", "[", "hello", "\n", "<" + chat.ESCAPE + "|end|>", "é"]
    for k in range(60):
        rows += [(k, n, rng.choice(["user", "assistant", "system", None]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) if rng.random() < 0.9 else None, "extra") for n in range(rng.randint(1, 6))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    found = {r.conv_id: r for r in chat.digest_conversations(chat.format_conversations(frame)).collect()}
    turns = collections.defaultdict(list)
    for k, _, role, text, _ in rows:
        turns[k].append((role or "", text or ""))
    for k, want in turns.items():
        loss = "".join(t for role, t in want if role == "assistant")
        assert (found[k].n_turns, found[k].turns_sha256) == (len(want), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in want).encode()).hexdigest())
        assert (found[k].loss_chars, found[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert not any(c in chat.render("user", t)[0][15:-7] for _, t in want for c in chat.CONTROLS)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_near_dedup(spark, odd):
    rng = random.Random(8)
    words = [f"q{k}" for k in range(200)]
    texts = list(odd)
    for group in range(6):
        base = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        for n in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append((100 + 20 * group + n, " ".join(copy)))
    sets = {k: shingle_set(t) for k, t in texts}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    found = {r.doc_id: r for r in near_dedup.near_groups(spark, docs_of(spark, texts)).collect()}
    assert {k: (r.n_shingles, r.component_id, r.kept) for k, r in found.items()} == {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def test_near_copies_of_every_text_of_an_id(spark):
    """Each text of an id, and of no id, has a near copy under an id of its own."""
    bases = [" ".join(f"{x}{k}" for k in range(60)) for x in "abcd"]
    texts = [*zip((5, 5, None, None), bases, strict=True), *((10 + k, f"{t} tail") for k, t in enumerate(bases)), (3, "z " + bases[1])]
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(spark, spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found == {(5, 5, True), (5, 3, False), (None, None, True), (10, 5, False), (11, 3, False), (12, None, False), (13, None, False), (3, 3, True)}


def test_bytes_that_agree_by_chance_do_not_hide_a_pair():
    """The marks agree in bands 0 to 19, the full hashes only from band 9 on: the pair is tested in bucket 9, and only there."""
    text = " ".join(f"w{k}" for k in range(50))
    near, marks = text.replace("w49", "v49"), [bytes(128), bytes(80) + bytes([1] * 48)]
    bands = [list(range(32)), [100 + k if k < 9 else k for k in range(32)]]
    found = []
    for band in (9, 10):
        rows = {"bucket": [band] * 2, "low": [0] * 2, "high": [0] * 2, "band": [band] * 2, "rep": [1, 2], "root": [1, 2], "side": [1, 2], "text": [text, near], "n_shingles": [46, 46], "bands": bands, "marks": marks}
        found.append(near_dedup.link_block(5, 75)(pa.table(rows)).to_pylist())
    assert found == [[{"a": 1, "b": 2}], []]


def test_super_min_hash_estimates():
    rng, errors = np.random.default_rng(1), []
    for _ in range(100):
        x = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = super_min_hash([x[:300], x[100:]])
        errors.append((a == b).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


@pytest.mark.parametrize(("remove", "length", "hot"), [(substring_dedup.remove_repeats, 35, 20_000), (suffix_dedup.remove_matches, 50, 20_000), (substring_dedup.remove_repeats, 9, 20_000), (suffix_dedup.remove_matches, 8, 20_000), (substring_dedup.remove_repeats, 35, 2), (suffix_dedup.remove_matches, 50, 2), (suffix_dedup.remove_matches, 21, 3)])
def test_repeats(spark, odd, remove, length, hot):
    """Against brute force, also where every repeated minimiser counts as hot; rows with no id and several texts under one id."""
    rng, base = random.Random(length), odd[3][1].split()
    texts = [*odd, (50, "a b c " * 40), (51, None), (52, odd[3][1][50:900]), (None, odd[3][1][200:1100]), (None, "x " + odd[3][1][:300]), (53, "tail " * 3 + odd[3][1][-500:]), (53, odd[3][1][-420:] + " end")]
    for k in range(60):  # cuts of one text, put together, share words to the left or the right only
        at, size = rng.randrange(250), rng.randint(10, 70)
        texts.append((60 + k, " ".join([*(f"own{k}x{n}" for n in range(rng.randint(0, 30))), *base[at : at + size], *base[at + rng.randint(0, 3) : at + rng.randint(4, 60)], f"z{k}"])))
    words = [(k, (t or "").encode().split()) for k, t in texts]
    starts = collections.Counter(tuple(w[p : p + length]) for _, w in words for p in range(len(w) - length + 1))
    want = []
    for k, w in words:
        gone = {q for p in range(len(w) - length + 1) if starts[tuple(w[p : p + length])] > 1 for q in range(p, p + length)}
        want.append((k, len(w), len(gone), hashlib.sha256(b" ".join(x for q, x in enumerate(w) if q not in gone)).hexdigest()))
    found = remove(spark, docs_of(spark, texts), length, hot).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)


def test_subtrees_split_by_longer_prefixes():
    words = np.array([[1, 1, 1, k // 4 + 1, k % 4 + 1] for k in range(16)], np.uint64)
    groups = list(substring_dedup.subtrees(words, np.arange(16), np.zeros(16, np.int64), 5, 5))
    assert sorted(np.concatenate(groups).tolist()) == list(range(16)) and max(map(len, groups)) <= 5
    assert [len(g) for g in substring_dedup.subtrees(words, np.zeros(9, np.int64), np.zeros(9, np.int64), 5, 5)] == [9]


def test_decontamination(spark, odd):
    item = " ".join(f"Term{k}" for k in range(14))
    texts = [*odd, (60, "x " + " ".join(item.split()[2:12]) + " y"), (61, " ".join(item.split()[:9])), (62, "SHORT, item!"), (63, item + " " + item), (64, "term0 term1 z term2 term3 term4 term5 term6 term7 term8 term9")]
    bench = spark.createDataFrame([(1, item, "x"), (2, "short item", "x"), (3, None, "x"), (4, "...", "x"), (1, item, "x")], "item_id long, text string, doc_id string")
    index = decontaminate.Index(spark, docs_of(spark, texts), bench)
    found = {r.doc_id: r for r in index.exact().collect()}
    assert {k: (r.n_hit, r.n_items) for k, r in found.items() if r.contaminated} == {60: (10, 1), 62: (2, 1), 63: (28, 1)}
    assert found[1].items_sha256 == EMPTY and found[1].n_words == 0 and len(found) == len(texts)
    assert found[62].items_sha256 == hashlib.sha256(b"2").hexdigest()
    assert 64 in {r.doc_id for r in index.near(5).collect()}


def test_mixing(spark, odd):
    rng = random.Random(9)
    rows = [(k, " ".join(["w"] * rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice(["src0"] * 6 + ["src1", "src2"])) for k in range(4000)]
    targets = mixing.Targets(source={"src0": 0.2, "src1": 0.4, "src2": 0.4}, lang={"en": 0.7, "de": 0.3}, topic={"brief": 1.0}, keep=0.15)
    found = mixing.mix(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), targets).collect()
    mass = lambda f: sum(r.n_tokens * r.probability for r in found if f(r))
    total = mass(lambda r: True)
    assert abs(mass(lambda r: r.source == "src1") / total - 0.4) < 1e-3 and abs(mass(lambda r: r.lang == "en") / total - 0.7) < 1e-3
    taken = sum(r.n_tokens for r in found if r.sampled)
    assert abs(taken / total - 1) < 0.1 and all(0 <= r.probability <= 1 for r in found)
    assert mixing.mix(spark, docs_of(spark, odd)).count() == len(odd)


def test_chances_sum_to_one():
    rng = np.random.default_rng(2)
    runs = np.unique(rng.integers(97, 101, (300, 5)).astype(np.uint64) @ (np.uint64(1) << np.arange(48, -1, -12).astype(np.uint64)))
    counts = rng.integers(0, 9, len(runs))
    base = np.zeros(4096)
    base[97:101] = 0.25
    context = runs[counts > 0][0] >> np.uint64(12)
    every = np.unique(np.append(runs, (context << np.uint64(12)) + np.arange(97, 101, dtype=np.uint64)))
    all_counts = np.zeros(len(every), int)
    all_counts[np.searchsorted(every, runs)] = counts
    p = quality.chances(every, all_counts, base)
    assert abs(p[every >> np.uint64(12) == context].sum() - 1) < 1e-6


def test_quality(spark, odd):
    rng = random.Random(11)
    good = lambda: " ".join(rng.choice(["the", "thing", "and", "then", "heron", "other"]) for _ in range(80))
    texts = [(k, good() + (" idiot moron scum" if k % 5 == 0 else "")) for k in range(100, 1100)] + [(k, "%%% zq## 93x@@ " * 30) for k in range(2000, 2020)]
    labels = spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(100, 800)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in quality.classify(spark, docs_of(spark, [*texts, *odd], collections.defaultdict(lambda: "en") | {1: None, 10: "xx"}), labels).collect()}
    held = [k for k in range(800, 1100)]
    assert not any(found[k].kept for k in held if k % 5 == 0) and sum(found[k].kept for k in held if k % 5) >= 0.97 * 240
    assert not any(found[k].kept for k in range(2000, 2020))
    assert found[1].kept and found[1].perplexity is None and found[2].perplexity is None and found[10].kept and len(found) == len(texts) + len(odd)


def test_one_wrong_label_does_not_set_a_limit(spark):
    rng = random.Random(3)
    rows = [("en", rng.gauss(50, 3), rng.gauss(5, 1)) for _ in range(2000)] + [("de", rng.gauss(60, 3), rng.gauss(6, 1)) for _ in range(100)] + [("de", 400.0, 80.0), ("xx", 9.0, 1.0)]
    found = {r.lang: r for r in quality.limits_of(spark.createDataFrame(rows, "lang string, perplexity double, peak double"), 0.995).collect()}
    assert 55 < found["en"].most_perplexity < 60 and 7 < found["en"].most_peak < 9
    assert 64 < found["de"].most_perplexity < 75 and 8 < found["de"].most_peak < 12 and found["xx"].most_peak < 1.1
    assert not quality.limits_of(spark.createDataFrame([], "lang string, perplexity double, peak double"), 0.995).collect()
