"""Quality rules, decontamination, BPE and token counts against brute force."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import re
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import byte_bpe, decontamination, quality, token_counts

from .conftest import CLASHING, edge_rows, found

VOCABULARY = path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# --- BPE ------------------------------------------------------------------------------------


def odd_texts():
    rng = random.Random(2)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "'LL", "é", "中文", "1", "23", "!", "##", "　", "\xa0",
            "\x1c", "\x85", "<|endoftext|>", "<|endof", "\0", "\0<|endoftext|>", "👍", "​", " \n", "The", "aaaa"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    return [*made, "", "a" * 20000, " " * 3000, "\n", "\\", "é" * 500, "ab" * 4000]


def test_bpe_equals_the_library(library):
    rows = odd_texts()
    coder = byte_bpe.ByteBpe(VOCABULARY)
    ids, counts = coder.encode_batch(rows)
    for text, own in zip(rows, np.split(ids, np.cumsum(counts)[:-1])):
        ref = library.encode(text, add_special_tokens=False).ids
        assert own.tolist() == ref
        assert coder.decode(own) == library.decode(ref, skip_special_tokens=False) == text


def test_bpe_forgets_words_without_changing_ids(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED_WORDS", 5)
    coder = byte_bpe.ByteBpe(VOCABULARY)
    for _ in range(2):
        for text in odd_texts()[:50]:
            assert coder.encode_batch([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_decode_of_broken_bytes_is_replaced(library):
    coder = byte_bpe.ByteBpe(VOCABULARY)
    ids = library.encode("é", add_special_tokens=False).ids
    byte = coder.encode_batch(["中"])[0]
    assert coder.decode(byte[:1]) == library.decode(byte[:1].tolist(), skip_special_tokens=False)
    assert coder.decode(np.array(ids)) == "é"


def test_round_trip(edge, wide, empty, library):
    rows = []
    for d, t in edge_rows():
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4")
        rows.append((d, len(ids), sha256(ids.tobytes()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    assert found(byte_bpe.round_trip(edge, VOCABULARY)) == sorted(rows, key=repr)
    assert found(byte_bpe.round_trip(wide, VOCABULARY)) == sorted(rows, key=repr)
    assert byte_bpe.round_trip(empty, VOCABULARY).count() == 0


def test_encode_and_decode_columns(edge):
    coded = edge.withColumn("ids", byte_bpe.bpe_encode(VOCABULARY)("text"))
    back = coded.withColumn("back", byte_bpe.bpe_decode(VOCABULARY)("ids"))
    assert back.filter("back <> coalesce(text, '')").count() == 0


# --- token counts ---------------------------------------------------------------------------


def test_length_histogram_and_totals(edge, empty, library):
    lengths = sorted(len(library.encode(t or "", add_special_tokens=False).ids) for _, t in edge_rows())
    histogram = token_counts.length_histogram(edge, VOCABULARY)
    assert found(histogram) == sorted(Counter(lengths).items(), key=repr)
    totals = token_counts.context_totals(histogram)
    for r in totals.collect():
        limit = r.n_tokens
        assert r.docs_within == sum(x <= limit for x in lengths)
        assert r.tokens_within == sum(x for x in lengths if x <= limit)
        assert r.docs_over == sum(x > limit for x in lengths)
        assert r.tokens_over == sum(x for x in lengths if x > limit)
        assert r.truncated_tokens == sum(min(x, limit) for x in lengths)
        assert lengths[r.rank_from - 1 : r.rank_to] == [limit] * r.n_docs
    limits = [0, 1, 77, 512, 10**6]
    for r in token_counts.at_limits(histogram, limits).collect():
        assert r.truncated_tokens == sum(min(x, r.limit) for x in lengths)
        assert (r.docs_within, r.docs_over) == (sum(x <= r.limit for x in lengths), sum(x > r.limit for x in lengths))
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.share: r.quantile for r in token_counts.quantiles(totals, shares).collect()}
    assert got == {s: lengths[max(0, int(np.ceil(s * len(lengths))) - 1)] for s in shares}
    assert token_counts.context_totals(token_counts.length_histogram(empty, VOCABULARY)).count() == 0


def test_totals_across_ranges(spark):
    rows = [(n, n % 7 + 1) for n in range(0, 30000, 611)]
    totals = token_counts.context_totals(spark.createDataFrame(rows, "n_tokens long, n_docs long"))
    for r in totals.collect():
        assert r.truncated_tokens == sum(min(n, r.n_tokens) * c for n, c in rows)
        assert r.docs_over == sum(c for n, c in rows if n > r.n_tokens)


# --- quality --------------------------------------------------------------------------------


def base_values(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit.update((i, i + 1, i + 2))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


def test_base_values(edge, wide, empty):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted(((d, *base_values(t)) for d, t in edge_rows()), key=repr)
    assert found(quality.quality_report(edge).select(names)) == want
    assert found(quality.quality_report(wide).select(names)) == want
    assert quality.quality_report(empty).count() == 0
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", " ", "\n", "é", "\t", "\x1c", "#", "　"]) for _ in range(120))
        got = quality.judge(text.encode(), quality.LineRules(), False)
        assert got[:6] == base_values(text)


def test_line_rules():
    rules = quality.LineRules()

    def fails(line):
        return quality.line_fails(line.encode(), len(line.split()), rules)

    assert fails("A plain sentence, with a comma and an end.") == ""
    assert fails("Truncated line without an end") == ""
    assert fails("One thought... and another! Is it? Yes.") == ""
    assert fails("BUY!! NOW!! CHEAP!! OFFER!!") == "punctuation"
    assert fails("word### other*** third$$$ fourth.") == "punctuation"
    assert fails("Home | Products | About | Contact") == "navigation"
    assert fails("Home › Garden › Tools › Rakes") == "navigation"
    assert fails("Home|Products|About|Contact") == "navigation"
    assert fails("| a | b | c | d |") == fails("(a||b) or |x| and |y| hold.") == fails("f(|x|, |y|) || g") == ""
    assert fails("« Oui » dit-elle, « non » dit-il, « enfin » dit l’autre.") == ""
    assert fails("Copyright 2020. All Rights Reserved.") == "boilerplate"
    assert fails("© 2020 Alle Rechte vorbehalten.") == fails("TOUS DROITS RÉSERVÉS") == "boilerplate"
    assert fails("Todos los derechos reservados.") == "boilerplate"
    assert fails("All rights reserved. " + " ".join(f"word{i}" for i in range(30)) + ".") == ""
    assert fails(" ".join(["word"] * 60)) == "punctuation"


def test_sentences_end_in_every_script(spark):
    words = " ".join(f"word{i}" for i in range(60))
    ends = ["।", "॥", "۔", "؟", "։", "።", "။", "។", "。", "！", "？", "．", "｡", "…", "‼", "༎", "᠃", "𑁇"]
    ends += [".[1]", '."', ".”", ".“", ".’", ".»", ".)", '?")', "!]", ".[12][a]", ".[citation needed]", ".²", ".†",
             ".**", "._", ".(3)", ".\u200f", ".\xa0"]
    docs = spark.createDataFrame(list(enumerate(words + e for e in ends)), "doc_id long, text string")
    lost = [ends[r.doc_id] for r in quality.quality_report(docs).filter("not kept").collect()]
    assert lost == []
    assert all(quality.has_sentence_end(f"one{e} two".encode()) for e in ends)
    for none in ("3.14", "example.com/a", "a,", "node.js[1]x", "x.(y)z", "", "[.]x", "(1)", '"', "l’eau"):
        assert not quality.has_sentence_end(f"one {none} two".encode())
        assert quality.line_fails(f"{words} {none} two".encode(), 62, quality.LineRules()) == "punctuation"


def test_documents_that_lose_too_much_go(spark, wide):
    good = " ".join(f"word{i}" for i in range(60)) + "."
    menu = " | ".join(f"item{i}" for i in range(12))
    rows = [(1, good), (2, f"{good}\n{menu}"), (3, f"{menu}\n{menu}x\n{good}"), (4, None), (5, "short.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    kept = {r.doc_id: r for r in quality.clean_documents(docs).collect()}
    assert set(kept) == {1, 2} and kept[2].text == good and kept[2].n_chars == len(good)
    out = quality.clean_documents(wide)
    assert out.columns == wide.columns
    assert all(r[n] == "own" for r in out.collect() for n in CLASHING)


def test_verdicts_follow_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    report = quality.quality_report(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = report.join(labels, "doc_id").filter("not base_failed").select("quality", "kept").collect()
    assert {q for q, k in rows if k} == {1} and {q for q, k in rows if not k} == {0}


# --- decontamination ------------------------------------------------------------------------


def split_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination(docs, items, width):
    windows = {}
    for item, text in items:
        w = split_words(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + width]), set()).add("" if item is None else str(item))
    out = []
    for d, text in docs:
        w, hit, ids = split_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                who = windows.get(tuple(w[i : i + size]))
                if who:
                    hit.update(range(i, i + size))
                    ids |= who
        digest = sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def benchmark_rows():
    texts = [t for _, t in edge_rows()]
    return [
        (1, texts[0]), (2, texts[0]), (10, "two words"), (11, None), (12, " .,! "), (None, "UNLIKE any—other"),
        (13, texts[1][50:300].upper()), (14, "x"), (15, "x x"), (2, texts[3][:90]), (16, "a" * 50),
    ]


@pytest.mark.parametrize("limit", [200_000, 40])
def test_contamination(spark, edge, wide, limit):
    items = spark.createDataFrame(benchmark_rows(), "item_id long, text string")
    for width in (10, 3):
        want = contamination(edge_rows(), benchmark_rows(), width)
        for docs in (edge, wide):
            report = decontamination.contamination_report(docs, items, width, limit)
            assert found(report.drop("byte_spans")) == want


def test_spans_are_those_of_the_original(spark):
    text = "Intro: Éa!\n THE  quick-brown fox; jumps over. End"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "the quick brown fox jumps")], "item_id long, text string")
    row = decontamination.contamination_report(docs, items).first()
    assert [text.encode()[a:b].decode() for a, b in row.byte_spans] == ["THE  quick-brown fox; jumps"]


def test_dropping_contaminated(spark, wide, empty):
    items = spark.createDataFrame([(1, "two words")], "item_id long, text string")
    out = decontamination.drop_contaminated(wide, items)
    assert out.columns == wide.columns and out.count() == wide.count() - 1
    assert decontamination.drop_contaminated(wide, items.limit(0)).count() == wide.count()
    assert decontamination.contamination_report(empty, items).count() == 0


def test_blocks_give_the_same_report(spark, edge):
    """Ids of any type; a passage that many items share; spans in bytes."""
    named = edge.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    items = [(f"q{i}", "two words and a tail that many items share") for i in range(40)]
    items += [(f"p{i}", t) for i, t in benchmark_rows()] + [("s", "two words"), (None, "First line here")]
    table = spark.createDataFrame(items, "item_id string, text string")
    one = found(decontamination.contamination_report(named, table, 3))
    assert found(decontamination.contamination_report(named, table, 3, 25)) == one
    assert any(row[5] and row[6] for row in one)
