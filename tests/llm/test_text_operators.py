"""Quality rules, PII, licenses, packing, byte-level BPE and chat formatting against plain definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from gleaner.llm import bpe, chat, licenses, packing, pii, quality
from gleaner.llm.queries import BYTE_BPE, WORD_BPE

ODD = [
    None, "", " \t\n", "x", "a b c d e a b c d e a", "One line\nOne line\n\nOne line", "naïve café – “quotes” 日本語 \U0001f600",
    "tab\x0bform\x0cnbsp end\x85 \x1c", "word " * 3000, "don't I'LL we're '' 'S 12½ x²_µ", "<|endoftext|> <turn:x> \\ </turn>",
    "mail a@b.co, b@c.d.e@f.gh or x+y@z.org; 10.0.0.255 1.2.3.4.5 256.1.1.1 4111 1111 1111 1111 +1 (980) 555-6268 +49-1",
    "IBAN DE89 3704 0044 0532 0130 00 password=hunter2222", "4111-1111-1111-1112 4111111111111111",
]


def frame(spark, texts, **more):
    rows = [(i, t, "en", "s", 0, 1.5) for i, t in enumerate(texts)]
    kinds = "doc_id long, text string, words string, id string, n_words int, score double"
    return spark.createDataFrame([(i, t, "w", "clash", 7, 0.5) for i, t, *_ in rows], kinds)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_base(text):
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_metrics_and_rules(spark):
    random.seed(3)
    texts = ODD + [" ".join(random.choice("abcdef") for _ in range(60)) for _ in range(20)] + ["the &&& of $$$ and " * 20]
    rows = quality.judge(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain_base(texts[r["__row"]["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        few = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert bool({"few_words", "repeated_words"} & set(r["failed_rules"])) == few
        assert r["kept"] == (not r["failed_rules"])
    assert "symbols" in next(r for r in rows if r["__row"]["doc_id"] == len(texts) - 1)["failed_rules"]


def test_quality_filter_keeps_columns_and_runs_no_python(spark):
    docs = frame(spark, ODD + ["a clean text of some twelve words that says the same thing once only"])
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert "Python" not in kept._jdf.queryExecution().executedPlan().toString()
    assert len(ODD) in {r["doc_id"] for r in kept.collect()}
    assert quality.filter_documents(docs.limit(0)).count() == 0
    mine = (quality.Rule("short", "n_words", low=3),)
    assert quality.filter_documents(docs, mine).count() == sum(len(words_of(t)) >= 3 for t in ODD) + 1


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(digits[::-1])]
            luhn = sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0
            good = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def test_pii_spans_and_redaction(spark):
    random.seed(5)
    texts = ODD + ["".join(random.choice("a1@.+- (4") for _ in range(200)) for _ in range(200)]
    found = {r["id"]: r["spans"] for r in pii.spans_of(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        base = [(s["kind"], s["start"], s["end"]) for s in found[i] if s["kind"] in pii.BASE_KINDS]
        assert base == plain_spans(t or ""), t
    kinds = {s["kind"] for s in found[12]}
    assert "iban" in kinds and "secret" in kinds
    assert not any(s["kind"] == "card" and s["start"] == 0 for s in found[13])
    clean = pii.redact(frame(spark, texts))
    assert clean.columns == frame(spark, []).columns
    by_id = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert by_id[0] is None and by_id[12].startswith("IBAN [IBAN] password=[SECRET]")
    assert pii.redact(frame(spark, [])).count() == 0


def test_context_moves_the_score():
    assert pii.find_spans("ssn 123-45-6789")[0].kind == "ssn"
    assert pii.find_spans("part 123-45-6789") == []
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")


def test_ibans_beside_upper_case_words_and_numbers():
    one, two, other = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947"
    ibans = lambda t: [t[s.start : s.end] for s in pii.find_spans(t) if s.kind == "iban"]
    for text, want in [
        (f"{one} BIC COBADEFFXXX", [one]), ("DE89370400440532013000 EUR 50", ["DE89370400440532013000"]),
        (f"{one} {two}", [one, two]), (f"{two} {other} {one} A1", [two, other, one]), (f"REF12 {other} 7", [other]),
        (f"AB12 {one} OK", [one]), (f"{one}X", []), (f"X{two}", []), ("DE89 3704 0044 0532 0130 01 BIC", []), (f"{one}.", [one]),
    ]:
        assert ibans(text) == want, text
    assert pii.redacted(f"pay {one} BIC COBADEFFXXX") == "pay [IBAN] BIC COBADEFFXXX"


def test_license_matches(spark):
    texts = ODD + [
        "x y Released under the MIT License. z", "Licensed under the old Apache License, Version 2.0.", "released UNDER the mit license " * 2,
        "under license terms of version two", "pad " * 500 + "Licensed under CC BY-NC 4.0.",
    ]
    found = defaultdict(list)
    for r in licenses.scan_documents(frame(spark, texts)).collect():
        found[r["id"]].append(r)
    base = len(ODD)
    assert [(r["license_id"], r["coverage"], texts[base][r["start"] : r["end"]]) for r in found[base]] == [
        ("MIT", 1.0, "Released under the MIT License")
    ]
    assert len(found[base + 1]) == 1 and len(found[base + 1][0]["runs"]) == 2
    assert len(found[base + 2]) == 2 and len(found[base + 4]) == 1
    assert set(found) <= set(range(base, base + 5))
    assert licenses.scan_documents(frame(spark, texts), []).count() == 0
    assert licenses.scan_documents(frame(spark, [])).count() == 0


def test_alignment_equals_full_search():
    """Within a band as wide as the texts, the alignment matches as many words as any local alignment of the same score."""
    random.seed(9)
    for _ in range(30):
        a, b = ([random.choice("abc") for _ in range(random.randrange(1, 9))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = max(
                    0, table[i, j] + (2 if a[i] == b[j] else -1), table[i, j + 1] - 1, table[i + 1, j] - 1
                )
        pairs = licenses.align(a, b, 0, 20)
        assert all(a[i] == b[j] for i, j in pairs) and (len(pairs) > 0) == (table.max() > 0)
        assert pairs == sorted(pairs)


def test_byte_bpe_equals_the_library(spark):
    random.seed(1)
    ranks = bpe.ranks_of(BYTE_BPE)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    signs = lambda: random.choice([random.randrange(32, 127), random.randrange(160, 600), random.randrange(0x2000, 0x3100), 32, 10])
    texts = ODD + ["".join(chr(signs()) for _ in range(200)) for _ in range(60)] + ["aaaa" * 50 + "ababab" * 30]
    rows = bpe.encode_texts(frame(spark, texts), BYTE_BPE, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["id"]] or ""
        ids = library.encode_ordinary(text)
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == text
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    ids = spark.createDataFrame([(1, library.encode_ordinary("ünï 1")), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r["id"]: r["text"] for r in bpe.decode_ids(ids, BYTE_BPE).collect()} == {1: "ünï 1", 2: "", 3: ""}


def test_replay_where_a_merge_makes_a_lower_rank():
    """A vocabulary no training would give: abc outranks ab, so its words go one by one."""
    rank = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 5, b"abc": 2, b"bc": 7, b"aa": 1, b"aaa": 0}
    ranks = bpe.Ranks(rank, {v: k for k, v in rank.items()})
    words = [b"xabcx", b"aaaaa", b"aabc", b"q", b"abcabc"]
    assert bpe.replay(words, ranks) == [bpe.encode_one(w, rank) for w in words]


def test_packing_places_every_id_once(spark):
    special = ["hello <|endoftext|> world", "<|startoftext|>é 漢", "<|ENDOFTEXT|> <|endoftext |>", "a\x1cb \x1f", "x\x85y\xa0z", "a<|endoftext|><|startoftext|>b " * 50]
    texts = ODD + special + ["same text"] * 40 + ["long words here " * 4000, "even " * 4096]
    placed = packing.pack(frame(spark, texts), WORD_BPE, with_ids=True).collect()
    model = Tokenizer.from_file(WORD_BPE)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in placed:
        by_doc[r["id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"], r["padded_to"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    for i, t in enumerate(texts):
        ids = model.encode(t or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == ids and pieces[0]["doc_tokens"] == len(ids)
    for parts in by_sequence.values():
        parts.sort()
        ends = [0] + [o + n for o, n, _ in parts]
        assert [o for o, _, _ in parts] == ends[:-1] and ends[-1] <= 4096
        power = ends[-1] & (ends[-1] - 1) == 0
        assert {p for _, _, p in parts} == {ends[-1] if power else 4096}
    assert packing.pack(frame(spark, []), WORD_BPE).count() == 0


def test_shortest_pack_first_on_histograms():
    random.seed(2)
    for _ in range(30):
        size = random.randrange(4, 60)
        counts = {random.randrange(1, size + 1): random.randrange(1, 40) for _ in range(10)}
        slots, patterns = packing.shortest_pack_first(counts, size)
        ranks, used = defaultdict(list), Counter()
        for s in slots:
            for r in range(s.n):
                ranks[s.length].append(s.low + r)
                sequence, at = s.first + r % s.packs, s.offset + s.length * (r // s.packs)
                used[sequence] += s.length
                assert at + s.length <= size
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}
        assert {p.first + k: p.used for p in patterns for k in range(p.packs)} == dict(used)


def parts_frame(spark, rows):
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>, text string, formatted int")


def test_chat_round_trip_and_attachments(spark):
    text = lambda t: ("text", t, None, None, None, None, None)
    rows = [
        (1, 0, "user", [text("see <image:0> \\"), ("image", None, "s3/a.png", 57, 28, None, None), text(" and "),
                        ("audio", None, "b.wav", None, None, 1.01, None), ("document", None, "c.pdf", None, None, None, 3)], "x", 1),
        (1, 1, "assistant", [text("<turn:user>fake</turn>")], "x", 1),
        (1, 2, "as>sis\\tant", [text(None)], "x", 1),
        (2, 0, None, None, None, None),
        (2, 0, None, None, None, None),
    ]
    turns = chat.format_turns(parts_frame(spark, rows)).collect()
    by = {(r["conv_id"], r["turn"]): r for r in turns}
    first = by[1, 0]
    assert first["formatted"] == "<turn:user>see \\<image:0> \\\\<image:0> and <audio:1><document:2></turn>"
    assert [(a["number"], a["kind"], a["ref"], a["tokens"]) for a in first["attachments"]] == [
        (0, "image", "s3/a.png", 3), (1, "audio", "b.wav", 26), (2, "document", "c.pdf", 4500)
    ]
    answer = by[1, 1]
    assert chat.unescape(answer["formatted"][answer["loss_start"] : answer["loss_end"]]) == rows[1][3][0][1]
    assert chat.parse("".join(by[1, k]["formatted"] for k in range(3)))[1:] == [
        ("assistant", "<turn:user>fake</turn>"), ("as>sis\\tant", "")
    ]
    assert len(turns) == 5
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(parts_frame(spark, rows))).collect()}
    assert back[2]["n_turns"] == 2 and back[1]["loss_chars"] == len("<turn:user>fake</turn>")
    assert chat.read_back(chat.format_turns(parts_frame(spark, []))).count() == 0


def test_unknown_part_is_an_error(spark):
    rows = [(1, 0, "user", [("video", None, None, None, None, None, None)], "x", 1)]
    with pytest.raises(Exception, match="unknown kind of part: video"):
        chat.format_turns(parts_frame(spark, rows)).collect()


def test_broken_output_is_an_error():
    with pytest.raises(ValueError):
        chat.parse("<turn:user>a</turn>b")


def test_null_ids_keep_other_ids_exact(spark):
    """Beside a null, ids above 2**53 must not pass through floats."""
    big = 2**53 + 1
    rows = [(None, "Released under the MIT License a@b.co"), (big, "Released under the MIT License a@b.co"), (big + 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {None, big, big + 2}
    assert {r["id"] for r in pii.spans_of(docs).collect()} == want
    assert {r["id"] for r in bpe.encode_texts(docs, BYTE_BPE, public_tokenizers.PATTERN).collect()} == want
    assert {r["id"] for r in packing.pack(docs, WORD_BPE).collect()} == want
    assert {r["id"] for r in licenses.scan_documents(docs).collect()} == {None, big}
    named = spark.createDataFrame([("a", "x"), (None, "y")], "doc_id string, text string")
    assert {r["id"] for r in pii.spans_of(named).collect()} == {"a", None}
