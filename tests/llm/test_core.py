"""The operators of ``quillsync.llm`` against plain versions on small inputs."""

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillsync.llm import bpe, chat, decontam, jaccard, katz, licences, packing, quality, secret_scan, sketch
from quillsync.llm.queries import QUERIES, crc_part, tokenizer
from quillsync.llm.text import Words, shingles, slices

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ODD = [None, "", " \n\t ", "a", "A b", "a B", "é\x85É Ünï 日本語", "x" * 5000, "w " * 9000, "\x00 \x1c \\ </s>"]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def grams(text, k=5):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def frame(spark, rows, schema="doc_id long, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def small():
    return pq.read_table(f"{SF}/documents.parquet").to_pydict()


def odd_rows():
    """Nulls, empty and long texts, repeated rows and a null id."""
    return [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (3, "a"), (None, "a b c d e f"), (None, None)]


# --- text ---------------------------------------------------------------------

def test_words_and_shingles_as_by_regex():
    texts = [t or "" for t in ODD] + small()["text"][:60]
    w = Words(pa.array(texts))
    assert w.counts.tolist() == [len(words_of(t)) for t in texts]
    names = {}
    for t, a, e in zip(texts, w.first[:-1], w.first[1:]):
        for word, h in zip(words_of(t), w.hash[a:e].tolist()):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)
    h, doc = shingles(w)
    for i, t in enumerate(texts):
        assert len(np.unique(h[doc == i])) == len(grams(t))


def test_slices_cover_all_rows_in_order():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (0, 5, 3, 50, 0, 7)])], names=["text"])
    cut = list(slices([batch, batch.slice(0, 0)], target=8))
    assert sum((b.column(0).to_pylist() for b in cut), []) == batch.column(0).to_pylist()
    assert all(b.num_rows == 1 or len("".join(b.column(0).to_pylist())) <= 8 for b in cut)


# --- 1 Katz -------------------------------------------------------------------

def katz_plain(rows, held):
    docs = [(words_of(t) + ["</e>"], h) for (_, t), h in zip(rows, held)]
    uni, pair, hist = Counter(), Counter(), Counter()
    for w, h in docs:
        if not h:
            uni.update(w)
            pair.update(zip(["<b>"] + w[:-1], w))
            hist.update(["<b>"] + w[:-1])

    def cc(c):
        return np.array([0] + [sum(v == r for v in c.values()) for r in range(1, katz.KATZ + 2)])

    e, d, n, top = katz.discounts(cc(uni)), katz.discounts(cc(pair)), sum(uni.values()), katz.KATZ + 1
    unknown = 1 - sum(e[min(c, top)] * c / n for c in uni.values())
    assert unknown > 0
    follow = defaultdict(list)
    for (h, w), r in pair.items():
        follow[h].append((w, r))

    def p(w):
        return e[min(uni[w], top)] * uni[w] / n if uni[w] else unknown

    back, all_p = {}, sum(p(w) for w in uni)
    for h, f in follow.items():
        left = sum((1 - d[r]) * r for _, r in f if r <= katz.KATZ) / hist[h]
        scale = 1.0
        if left <= 0:
            scale, left = hist[h] / (hist[h] + 1), 1 / (hist[h] + 1)
        back[h] = scale, left / (1 - sum(p(w) for w, _ in f))
        total = sum(scale * d[min(r, top)] * r / hist[h] for _, r in f) + back[h][1] * (
            unknown + all_p - sum(p(w) for w, _ in f))
        assert abs(total - 1) < 1e-9

    def logp(h, w):
        r = pair[h, w]
        if r:
            return math.log10(back[h][0] * d[min(r, top)] * r / hist[h])
        return (math.log10(back[h][1]) if h in back else 0) + math.log10(p(w))

    return [(len(w), sum(uni[x] > 0 for x in w), n,
             sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (len(uni) + 1))) for x in w),
             sum(logp(a, b) for a, b in zip(["<b>"] + w[:-1], w))) for w, _ in docs]


@pytest.mark.parametrize("parts", [4, 97])      # with 97 the common histories are split
def test_katz_scores(spark, parts, tmp_path):
    t = small()
    rows = list(zip(t["doc_id"], t["text"])) + [(1000 + i, x) for i, x in enumerate(ODD)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r for r in katz.scores(docs, crc_part("doc_id", 10) == 0, partitions=parts).collect()}
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    for (i, _), h, (n, known, total, base, score) in zip(rows, held, katz_plain(rows, held)):
        g = got[i]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (h, n, known, total)
        assert g.base_score == pytest.approx(base, rel=1e-9)
        assert g.score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_katz_without_training_rows_or_rows(spark):
    docs = frame(spark, [(1, "a b"), (None, None)], parts=1)
    got = katz.scores(docs, F.lit(True)).collect()
    assert [(r.score, r.n_known, r.train_tokens) for r in got] == [(0.0, 0, 0)] * 2
    assert katz.scores(docs.limit(0), F.lit(False)).count() == 0


# --- 2 licences ---------------------------------------------------------------

def test_licences_found_as_document_paragraph_and_line(spark):
    mit = licences.KNOWN[0][2]
    rows = [(1, mit.upper()), (2, "Copyright (c) 2020 Somebody\n\n" + mit.replace(" ", "\n", 3)),
            (3, "Some text.\nReleased under the M.I.T. Licence."), (4, "Some text. Released under the MIT License."),
            (5, "before\n\n" + mit + "\n\nafter\nreleased under the mit licence"), (6, ""), (7, None), (None, "x")]
    rows[2] = (3, "Some text.\n  RELEASED under the MIT Licence!")
    got = {r.doc_id: (r.license_id, r.notices, r.n_notices) for r in licences.scan(frame(spark, rows)).collect()}
    assert got[1][0] == got[2][0] == "MIT"
    assert got[3] == (None, "MIT", 1) and got[4] == (None, "", 0)
    assert got[5] == (None, "MIT", 2) and got[6] == got[7] == got[None] == (None, "", 0)


# --- 3 packing ----------------------------------------------------------------

def check_packing(pieces, tokens, limits):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for doc, ids in tokens.items():
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            part = np.array(ids[at:at + p.length], dtype="<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(part)
            at += p.length
        assert at == len(ids)
    padded = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits[0] and len(ps) <= limits[1] and sum(p.loss_tokens for p in ps) <= limits[2]
        padded += 0 if at & (at - 1) == 0 else limits[0] - at
    return padded


def test_packing_keeps_every_token_once(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    d = small()
    rows = list(zip(d["doc_id"], d["text"])) + [
        (1000, None), (1001, ""), (1002, "<|endoftext|> a<|endoftext|>"), (1003, "a  b \n c\x1c d   "),
        (1004, "½ Ⅷ x²\x85 y"), (1005, " lead"), (1006, "q" * 6000), (1007, "日本語 " * 3000)]
    tokens = {i: t.encode(x or "", add_special_tokens=False).ids + [1] for i, x in rows}
    pieces = packing.pack(frame(spark, rows), tokenizer("byte_bpe_50k.json")).collect()
    total = sum(map(len, tokens.values()))
    assert check_packing(pieces, tokens, (2048, packing.SEGMENTS, 2048)) <= 0.02 * total


def test_packing_under_three_limits(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.choice([0, 1, 3, 30, 300]))), rng.randrange(40))
            for i in range(300)]
    docs = frame(spark, rows, "doc_id long, text string, prompt int")
    pieces = packing.pack(docs, tokenizer("byte_bpe_50k.json"), loss_from="prompt", tokens=100, segments=3,
                          loss=60).collect()
    enc = packing.encoder(tokenizer("byte_bpe_50k.json"))
    tokens = {i: [*np.frombuffer(enc.encode(t), "<u4").tolist(), 1] for i, t, _ in rows}
    check_packing(pieces, tokens, (100, 3, 60))
    assert packing.pack(docs.limit(0), tokenizer("byte_bpe_50k.json")).count() == 0


# --- 4 Jaccard ----------------------------------------------------------------

def jaccard_plain(rows):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and both and \
                    100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[find(i)].append(doc)
    return sorted(((d, len(s), None if d is None else min(least[find(i)])) for i, ((d, _), s) in
                   enumerate(zip(rows, sets))), key=repr)


def near_copies(n, seed=3):
    rng = random.Random(seed)
    v = [f"w{i}" for i in range(2000)]
    base = [rng.choices(v, k=rng.choice([1, 3, 4, 5, 8, 40, 90])) for _ in range(25)]
    hot = rng.choices(v, k=60)
    rows = []
    for i in range(n):
        w = list(hot if i % 3 == 0 else rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(v)
        rows.append((i * 7 % n, " ".join(w[:max(1, int(len(w) * rng.choice([1, 1, 0.9])))])))
    return rows


def test_jaccard_components(spark):
    rows = near_copies(700) + [(2000 + (i or 0), t) for i, t in enumerate(ODD)] + [(None, "w1 w2"), (2003, "a")]
    got = jaccard.components(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == jaccard_plain(rows)


def test_overlaps_of_blocks_equal_set_sizes():
    sets = [np.array(sorted({hash(x) & (2**63 - 1) for x in grams(t)}), dtype=np.uint64) for _, t in near_copies(80)]
    both = jaccard.overlaps(sets)
    left = jaccard.overlaps(sets, np.array([5, 9]))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert both[i, j] == len(np.intersect1d(a, b))
    assert (left[:, 10:] == both[[5, 9], 10:]).all()


def test_jaccard_of_an_empty_table(spark):
    assert jaccard.components(frame(spark, [(1, "a")]).limit(0)).collect() == []


# --- 5 token counts -----------------------------------------------------------

def test_token_counts_equal_the_library(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    texts = [t or "" for t in ODD] + ["a  b ", " a", "▁x ▁▁", "ﬁ½ Ⅷ", "\r\n\t", "😀😀 a😀", " " * 70] + small()["text"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None)]
    got = bpe.token_counts(frame(spark, rows), tokenizer("piece_bpe_32k.model"), limit=50).collect()
    assert len(got) == len(rows)
    for r in got:
        t = texts[r.doc_id] if r.doc_id is not None else ""
        n = len(sp.encode(t))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 50)


# --- 6 decontamination --------------------------------------------------------

QUESTION = ("A farmer named Alice sells 12 apples and 30 pears at the market for 5 dollars each day. "
            "How many apples does Alice sell in 12 days if she keeps none of them?")


def test_decontamination_catches_new_parameters(spark):
    bench = frame(spark, [(1, QUESTION), (2, "too short"), (3, None), (None, QUESTION), (1, QUESTION), (9, QUESTION)],
                  "item_id long, text string")
    changed = QUESTION.replace("Alice", "Bob").replace("12", "77").replace("30", "8")
    broken = QUESTION.replace("12 days", "13 days")
    rows = [(1, "Words before it. " + QUESTION + " And after."), (2, "x y z " + changed.replace(",", "")),
            (3, broken), (4, "nothing of the kind here at all " * 5), (5, None), (6, ""), (None, QUESTION),
            (7, QUESTION.upper().lower()), (1, QUESTION)]
    got = {r.doc_id: r for r in decontam.contaminated(frame(spark, rows), bench).collect()}
    assert {1, 2} <= set(got) and not {3, 4, 5, 6, None} & set(got)
    assert got[1].item_id == got[2].item_id == 1
    assert got[1].changed_slots == 0 and got[2].changed_slots == 3
    assert decontam.contaminated(frame(spark, rows), bench.limit(0)).count() == 0
    assert decontam.contaminated(frame(spark, rows).limit(0), bench).count() == 0


def test_decontamination_types_names_wherever_they_stand(spark):
    tom = ("Tom has 12 red apples. Tom eats 3 apples at noon. Tom buys 15 more at the shop. "
           "Tom sells 4 of them. How many apples does Tom keep?")
    clips = ("In spring Natalia's shop sold clips to some of her friends and then half as many clips in May "
             "to the others there again.")
    odd = "When José-María met McDonald near the old bridge they both talked about the long rain and went home."
    items = [(1, tom), (2, clips), (3, odd)]
    rows = [(1, tom.replace("Tom", "Ann").replace("12", "40")), (2, clips.replace("Natalia's", "Zoe's")),
            (3, odd.replace("José-María", "Zoë").replace("McDonald", "O'Neill")), (4, tom.lower()), (5, clips.upper())]
    got = decontam.contaminated(frame(spark, rows), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 1), (5, 2)}


def test_decontamination_finds_verbatim_passages(spark):
    series, short = "12 15 18 21 24 27 30 33 36 39 what comes next", "What is the capital of France?"
    half = QUESTION[:QUESTION.index(" How many")]
    names = ("The river was cold when Ann came. The boats lay on the sand near the old wooden pier. "
             "The wind blew hard all night long.")
    items = [(1, series), (2, short), (3, QUESTION), (4, names), (5, "Yes")]
    # at the places of the item's second "Alice" and "12", other values that are no part of a matched window
    rows = [(1, "we read: " + series + " in a book"), (2, "He asked: what is the capital of France? Nobody knew."),
            (3, half + " Of all things it Mary was for 99 nights over"),
            (4, names.replace("The wind", "A wind")), (5, "and she said yes to all"),
            (6, QUESTION.replace("12 days", "13 days")), (7, "What is the capital of it and of France")]
    got = decontam.contaminated(frame(spark, rows), frame(spark, items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(1, 6)}


def test_decontamination_finds_all_planted_passages(spark):
    d = small()
    items = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()
    planted = {i for i, t in zip(d["doc_id"], d["text"]) if any(x in t for x in items)}
    assert planted <= {r.doc_id for r in QUERIES["op6_decontamination"](spark, SF).collect()}


# --- 7 secrets ----------------------------------------------------------------

def test_secret_spans_base_and_confirmed(spark):
    import base64
    der = bytes([0x30, 0x0D, 0x02, 0x01, 0x00, 0x02, 0x08]) + bytes(range(1, 9))
    long_der = b"\x30\x81\x8a\x02\x01\x00\x02\x81\x84" + b"\x11" * 132
    b64 = base64.b64encode(long_der).decode()
    # a private key's fields; a public one (the first three) is no secret
    ssh = b"".join(len(x).to_bytes(4, "big") + x for x in (b"ssh-rsa", b"\x00" + b"k" * 128, b"\x01\x00\x01",
                                                          b"d" * 128, b"i" * 64, b"p" * 64, b"q" * 64))
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256"}).encode()).decode().rstrip("=")
    body = base64.urlsafe_b64encode(json.dumps({"sub": "1"}).encode()).decode().rstrip("=")
    jwt, fake = f"{head}.{body}.c2ln", f"eyJub3QganNvbiBhdCBhbGw.{body}.c2ln"
    pem = f"-----BEGIN PRIVATE KEY-----\n{b64[:64]}\n{b64[64:]}\n-----END PRIVATE KEY-----"
    assert secret_scan.is_der_key(der) and secret_scan.is_der_key(long_der) and secret_scan.is_ssh_key(ssh)
    assert not secret_scan.is_der_key(long_der[:-1]) and not secret_scan.is_ssh_key(ssh[:-1])
    text = f"é {jwt} {fake} {b64} ssh-rsa {base64.b64encode(ssh).decode()} {long_der.hex().upper()}\n{pem}"
    kinds = [secret_scan.KINDS[k] for _, k, _ in sorted(secret_scan.confirmed_spans(text))]
    assert kinds == ["token", "der", "ssh", "der", "pem"]
    base = ("password=secret:abcdefghijklmnop PASSWD : 'abcdefghijkl' Api_Key=short AKIAABCDEFGHIJKLMN "
            "AKIASHORT deadbeefdeadbeef0 deadbeef ſecret=abcdefghijklmnop")
    spans = [("assign", "PASSWD : 'abcdefghijkl"), ("access", "AKIAABCDEFGHIJKLMN"), ("hex", "deadbeefdeadbeef0")]
    assert secret_scan.show(secret_scan.base_spans(base)) == ",".join(
        f"{k}:{base.index(x)}:{base.index(x) + len(x)}" for k, x in spans)
    rows = [(1, text), (2, base), (3, None), (None, "x"), (3, "")]
    got = {r.doc_id: r for r in secret_scan.scan(frame(spark, rows)).collect()}
    assert (got[2].n_assign, got[2].n_access, got[2].n_hex) == (1, 1, 1)
    assert got[None].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = secret_scan.redact(frame(spark, [(2, base, 7, "a"), (3, None, 0, "b")],
                                     "doc_id long, text string, n_chars long, __x string")).collect()
    clean = {r.doc_id: r for r in clean}
    assert "deadbeefdeadbeef0" not in clean[2].text and clean[2].n_chars == len(clean[2].text)
    assert clean[3].text is None and clean[3].n_chars == 0


def test_secret_spans_of_keys_as_they_leak():
    import base64
    import textwrap
    rng = np.random.default_rng(7)
    der = b"\x30\x82\x02\x0d\x02\x01\x00\x02\x82\x02\x06" + rng.bytes(518)
    assert secret_scan.is_der_key(der)
    lines = textwrap.wrap(base64.b64encode(der).decode(), 64)
    begin, end = "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"
    pem = "\n".join([begin, *lines, end])
    coded = base64.b64encode(pem.encode() + b"\n").decode()
    # text before, the span, its kind, text after
    cases = [('{"private_key": "', json.dumps(pem)[1:-1], "pem", '\\n", "x": 1}'),
             ("KEY='", pem.replace("\n", "\\n"), "pem", "'"),
             ('{"a": "', json.dumps(json.dumps(pem)[1:-1])[1:-1], "pem", '"}'),
             ("", pem.replace("\n", "\r\n"), "pem", ""),
             ("# ", pem.replace("\n", "\n# "), "pem", "\n# end"),
             ("// ", pem.replace("\n", "\n// "), "pem", ""),
             ("+", pem.replace("\n", "\n+"), "pem", ""),
             ('x = "', pem.replace("\n", '\\n" +\n    "'), "pem", '"'),
             ("  tls.key: ", coded, "pem", "\nkind: Secret"),
             ("  tls.key: |\n    ", "\n    ".join(textwrap.wrap(coded, 76)), "pem", "\nkind: Secret"),
             ("der:\n", "\n".join(lines), "der", "\nand so on"),
             ('k = "', "\\n".join(lines), "der", '\\n"'),
             ('k = "\\n', lines[0] + "\\n" + "\\n".join(lines[1:]), "der", '"')]
    for before, span, kind, after in cases:
        text = before + span + after
        found = [(secret_scan.KINDS[k], s, e) for s, k, e in secret_scan.confirmed_spans(text)]
        assert found == [(kind, len(before), len(before) + len(span))], text
        assert span[40:80] not in secret_scan.redacted(text)
    other = "\n".join(textwrap.wrap(base64.b64encode(b"\x30" + rng.bytes(9000)).decode(), 64))
    assert not secret_scan.confirmed_spans(other + "\n" + begin + "\n" + other + "\n" + end)


# --- 8 quality ----------------------------------------------------------------

def test_pairwise_sum_equals_the_double_loop():
    rng = np.random.default_rng(1)
    m = {"w0": 0.3, "w": rng.normal(size=quality.SIZE), "v": rng.normal(size=(quality.SIZE, quality.FACTORS))}
    ptr, index, x = quality.features(pa.array(["One two, two THREE!\nline 2 | x", "", "a"]))
    got = quality.raw_scores(m, ptr, index, x)
    for k, (a, b) in enumerate(zip(ptr[:-1], ptr[1:])):
        i, xi = index[a:b], x[a:b].astype(float)
        want = m["w0"] + (m["w"][i] * xi).sum() + sum(
            m["v"][i[p]] @ m["v"][i[q]] * xi[p] * xi[q] for p in range(len(i)) for q in range(p))
        assert got[k] == pytest.approx(want, rel=1e-5)


def test_quality_on_held_out_rows_and_odd_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op8_quality"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    labels = {x["doc_id"]: x["quality"] for x in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    docs = frame(spark, [(i, t, "x") for i, t in odd_rows()], "doc_id long, text string, score string")
    none = quality.train(docs, spark.createDataFrame([(1, None)], "doc_id long, quality int"))
    got = quality.score(docs, none).collect()
    assert len(got) == len(odd_rows()) and got[0].asDict().keys() == {"doc_id", "text", "score", "predicted"}
    assert quality.score(docs.limit(0), none).count() == 0


# --- 9 fingerprints -----------------------------------------------------------

def test_sketches_merge_and_estimate():
    t = small()["text"]
    long = " ".join(t[:40])
    a, b, both = sketch.sketches(pa.array([long, " ".join(t[20:60]), "  ".join([long, " ".join(t[20:60])])]))
    one, two = grams(long), grams(" ".join(t[20:60]))
    assert abs(sketch.resemblance(a, b) - len(one & two) / len(one | two)) < 0.15
    assert abs(sketch.containment(a, b) - len(one & two) / len(one)) < 0.2
    assert abs(sketch.distinct(a) / len(one) - 1) < 0.3
    assert abs(sketch.resemblance(sketch.merge(a, b), both) - 1) < 0.05
    assert (sketch.decode(sketch.encode(a)) == a).all()
    empty = np.zeros(0, dtype=np.uint64)
    assert sketch.resemblance(empty, empty) == 1 and sketch.resemblance(empty, a) == 0


def test_merged_sketch_of_parts(spark):
    t = small()["text"][:12]
    docs = frame(spark, [(i % 3, x) for i, x in enumerate(t)], "part long, text string")
    fps = sketch.fingerprint(docs, "part")
    for r in sketch.merged(fps, "part").collect():
        want = np.zeros(0, dtype=np.uint64)
        for s in sketch.sketches(pa.array([x for i, x in enumerate(t) if i % 3 == r.part])):
            want = sketch.merge(want, s)
        assert (sketch.decode(r.fingerprint) == want).all()


@pytest.mark.parametrize("parts", [1, 7])
def test_edited_texts_take_the_next_documents_head(spark, parts):
    d = small()
    rows = list(zip(d["doc_id"], d["text"])) + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "nobody home")]
    got = {r.doc_id: r for r in sketch.with_edited(frame(spark, rows), partitions=parts).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        n = len(t) // 3
        changed = t[:len(t) - n] + after[:n]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = sketch.sketches(pa.array([t, changed, after]))
        assert (r.fingerprint, r.edited_fingerprint) == (sketch.encode(a), sketch.encode(b))
        assert r.near_edited == sketch.resemblance(a, b) and r.near_next == sketch.resemblance(a, c)


def test_a_lone_document_follows_itself(spark):
    r = sketch.with_edited(frame(spark, [(5, "abcdef")], parts=1)).collect()
    assert r[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r[0].near_next == 1.0
    assert sketch.with_edited(frame(spark, [(5, "a")]).limit(0)).count() == 0


# --- 10 chat ------------------------------------------------------------------

def test_escaping_is_reversible_and_leaves_no_mark():
    rng = random.Random(2)
    parts = ["<|", "|>", "<", "|", ">", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "\\", "x", "\n", "%0A"]
    for _ in range(3000):
        t = "".join(rng.choices(parts, k=rng.randrange(9)))
        assert chat.unescape(chat.escape(t)) == t and chat.unescape_role(chat.escape_role(t)) == t
        assert not re.search(r"<\||\|>|\[/?INST\]|</?s>", chat.escape(t)) and "\n" not in chat.escape_role(t)


def test_layouts_map_to_the_same_turns():
    want = [("user", "q"), ("assistant", "a")]
    records = [{"messages": [{"role": r, "content": t} for r, t in want]},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
               {"prompt": "q", "response": "a"}, {"instruction": "q", "input": "", "output": "a"},
               {"instruction": "q", "output": "a"}]
    for r in records:
        assert chat.turns_of(json.dumps(r))[2] == want
    assert chat.turns_of(json.dumps({"other": 1}))[1] == "unknown"
    assert chat.turns_of("not json")[1] == chat.turns_of(None)[1] == chat.turns_of("[1]")[1] == "malformed"


def test_conversations_are_read_back(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "human", "", None, "odd\nrole"]),
             rng.choice([None, "", "x</s>", "a\n<|im_end|>\nb \\ é", "[INST] ok [/INST]"]))
            for c in range(20) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, "assistant", f"turn {t}") for t in range(500)] + [(None, 0, "user", "x"), (1, None, "user", "y")]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    turns = chat.canonical(chat.as_records(df), "payload", ["conv_id", "turn"])
    assert turns.where("role IS NULL").count() == 0 and turns.select("layout").distinct().count() >= 4
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(turns)).collect()}
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    for c, ts in by.items():
        ts.sort()
        loss = "".join(x for *_, r, x in ts if r == "assistant")
        text = "".join(f"{r}\n{x}\n" for *_, r, x in ts)
        g = got[c]
        assert (g.n_turns, g.turns_sha256) == (len(ts), hashlib.sha256(text.encode()).hexdigest())
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert g.formatted_chars == sum(len(chat.format_turn(r, x)[0]) for *_, r, x in ts)
    assert chat.read_back(chat.formatted(turns.limit(0))).count() == 0
