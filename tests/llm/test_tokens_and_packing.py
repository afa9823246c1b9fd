"""Token counts and packing against the library itself."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

from runloom.llm.packing import INNER_CUT, SENTENCE_CUT, WINDOW_COST, WordIds, pack_documents, plan_windows
from runloom.llm.token_counts import UNSAFE, TokenCounter, count_tokens, prove_whole_tokens

JSON, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [" ", "  ", "\n", "\t", " \n", "a", "Be", "'s", "'LL", "é", "É", "1", "23", "<|endoftext|>", ".", "!!", "漢", "ß", "x", "_", "\x85", "\x1c", "Σ", "ΑΣ", "ж", "́", "€", "İ", "ﬁ", "　", "the", "ing"]


def odd_texts(n, seed=3):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 16))) for _ in range(n)]


def test_counts_equal_the_library():
    counter, library = TokenCounter(JSON), Tokenizer.from_file(JSON)
    texts = odd_texts(4000)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_tokens_are_proven():
    library = Tokenizer.from_file(JSON)
    whole = prove_whole_tokens(JSON)
    assert len(whole) > 45_000 and all(len(library.encode(t, add_special_tokens=False).ids) == 1 for t in random.Random(1).sample(sorted(whole), 500))


def test_characters_are_classed_alike():
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    import regex

    own = regex.compile(public_tokenizers.PATTERN).findall
    for code in range(0, 0x3100):
        text = f"a{chr(code)}1{chr(code)}!{chr(code)}a"
        if not UNSAFE.search(text):
            assert [text[i:j] for _, (i, j) in split(text)] == own(text), hex(code)


def test_word_ids_equal_the_library():
    own, library = WordIds(WORDS), Tokenizer.from_file(WORDS)
    for text in odd_texts(3000):
        ids = np.frombuffer(own.document(text, 2)[0], "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids + [2]


def test_plan_is_the_cheapest():
    pick = random.Random(5)
    for _ in range(60):
        gaps = [pick.randint(1, 9) for _ in range(pick.randint(1, 24))]
        cuts = np.cumsum([0, *gaps])
        penalties = np.array([0.0, *[pick.choice([0, SENTENCE_CUT, INNER_CUT]) for _ in gaps]])
        size = 16
        best = [0.0] + [float("inf")] * len(gaps)
        for j in range(1, len(cuts)):
            for i in range(j):
                length = int(cuts[j] - cuts[i])
                if length <= size:
                    pad = 0 if length & (length - 1) == 0 else size - length
                    best[j] = min(best[j], best[i] + pad + penalties[j] + WINDOW_COST)
        chosen = plan_windows(cuts, penalties, size, closed=True)
        cost = 0.0
        for i, j in zip(chosen, chosen[1:]):
            length = int(cuts[j] - cuts[i])
            assert 0 < length <= size
            cost += (0 if length & (length - 1) == 0 else size - length) + penalties[j] + WINDOW_COST
        assert chosen[0] == 0 and chosen[-1] == len(cuts) - 1 and abs(cost - best[-1]) < 1e-9


def test_packing_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3, "doc_id")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pack_documents(docs, WORDS, with_ids=True).collect()
    library = Tokenizer.from_file(WORDS)
    pieces, windows = {}, {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    for key, text in texts.items():
        ordered = sorted(pieces[key], key=lambda r: r["start"])
        ids = [i for r in ordered for i in r["ids"]]
        assert ids == library.encode(text, add_special_tokens=False).ids + [2]
        assert [r["start"] for r in ordered] == np.cumsum([0, *[r["length"] for r in ordered]])[:-1].tolist()
        assert {r["doc_tokens"] for r in ordered} == {len(ids)}
    padding = 0
    for parts in windows.values():
        parts.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in parts] == np.cumsum([0, *[r["length"] for r in parts]])[:-1].tolist()
        used = sum(r["length"] for r in parts)
        assert used == parts[0]["window_length"] <= 4096
        padding += parts[0]["padded_length"] - used
    assert padding < 0.02 * sum(r["length"] for r in rows)


def test_counts_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    library = Tokenizer.from_file(JSON)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in count_tokens(docs, JSON).collect():
        n = len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 512)
