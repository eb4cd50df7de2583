"""SimHash groups, decontamination, chat windows and toxicity against plain Python, on odd rows."""

import collections
import hashlib
import random
import re
import zlib

import brute
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from loanlens.llm import chat_windows, decontamination, simhash_dedup, toxicity
from loanlens.llm.components import components
from loanlens.llm.text import prepared


@pytest.fixture(scope="module")
def docs(spark):
    return prepared(spark).createDataFrame(brute.DOCS, brute.SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.withColumns({name: F.lit("x") for name in brute.CLASHING})


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


# SimHash ------------------------------------------------------------------------------

@pytest.mark.parametrize("text", ["", "a", "A b", "Ä É word", "x y z", " a\tb\vc\nd ", "one two three four " * 50, " not a blank "])
def test_fingerprint(text):
    assert simhash_dedup.fingerprint(text.encode()) & (2**64 - 1) == brute.fingerprint(text)


def grouped(rows):
    ids = [r.doc_id for r in rows]
    prints = [int(r.fingerprint, 16) for r in rows]
    root = brute.components(prints)
    least = {}
    for i, r in zip(ids, root):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(r) for r in root]


def test_groups_equal_all_pairs(spark, docs, clashing):
    table = docs.select("doc_id", "text").unionByName(
        spark.read.parquet(f"{SMALL}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), "text"))
    rows = simhash_dedup.near_duplicates(table).collect()
    texts = collections.Counter((r.doc_id, f"{brute.fingerprint(r.text):016x}") for r in table.collect())
    assert collections.Counter((r.doc_id, r.fingerprint) for r in rows) == texts
    assert [r.component_id for r in rows] == grouped(rows)
    same(simhash_dedup.near_duplicates(docs), simhash_dedup.near_duplicates(clashing))
    assert simhash_dedup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("blocks, bucket", [(5, 64), (5, 1), (4, 2), (3, 3)])
def test_links_of_crowded_buckets_lose_nothing(spark, blocks, bucket):
    """Many fingerprints around a few centres: the same components whatever the size of a bucket."""
    draw = random.Random(blocks * 10 + bucket)
    prints = set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(4))}))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = prepared(spark).createDataFrame([(p,) for p in signed], "fp long")
    linked = simhash_dedup.links(frame, 2, blocks, bucket)
    mask = 2**64 - 1
    assert all(((r.a & mask) ^ (r.b & mask)).bit_count() <= 2 for r in linked.collect())
    found = {r.node: r.root for r in components(linked, "a", "b").collect()}
    root = brute.components(prints)
    expected = {frozenset(signed[i] for i in range(len(root)) if root[i] == r) for r in set(root)}
    got = collections.defaultdict(set)
    for p in signed:
        got[found.get(p, p)].add(p)
    assert {frozenset(g) for g in got.values()} == expected


def test_components_of_a_long_chain(spark):
    prepared(spark)
    chain = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    ring = spark.createDataFrame([(1000, 1001), (1001, 1002), (1002, 1000), (1000, 1000), (1000, 1001)], "a long, b long")
    found = {r.node: r.root for r in components(chain.unionByName(ring), "a", "b").collect()}
    assert found == {**dict.fromkeys(range(1, 201), 1), **dict.fromkeys(range(1000, 1003), 1000)}
    assert components(chain.limit(0), "a", "b").count() == 0


def test_one_of_each_group_stays(docs, clashing):
    rows = [(i, brute.fingerprint(t)) for i, t, *_ in brute.DOCS]
    root = brute.components([f for _, f in rows])
    expected = sorted(str(min((i for (i, _), r in zip(rows, root) if r == k and i is not None), default=None)) for k in set(root))
    kept = simhash_dedup.keep_first(clashing)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == expected
    assert simhash_dedup.keep_first(docs.limit(0)).count() == 0


# Decontamination ----------------------------------------------------------------------

VOCABULARY = [f"{a}{b}" for a in "the and onto with erly tion ouer dann wenn quel".split() for b in "a e i o u st nd sh".split()]


def sentence(draw, n):
    return " ".join(draw.choice(VOCABULARY) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def exam():
    draw = random.Random(5)
    items = [(i, "\n".join(sentence(draw, draw.randrange(4, 30)) for _ in range(draw.randrange(1, 9)))) for i in range(60)]
    items += [(60, "Tiny one."), (61, ""), (62, None), (63, items[3][1]), (64, sentence(draw, 300))]
    texts = []
    for i in range(300):
        text = sentence(draw, draw.randrange(1, 400))
        if i % 3 == 0:
            item = items[i % 60][1] if i % 30 else items[64][1]
            words = item.split()
            if i % 2:
                words[draw.randrange(len(words))] = "CHANGED"
            text = f"{text} {' '.join(words).upper() if i % 4 else item} {sentence(draw, draw.randrange(1, 200))}"
        elif i % 3 == 1:
            words = items[i % 60][1].split()
            text += " " + " ".join(words[: len(words) // 2])
        texts.append((i, text))
    return items, [*texts, (900, None), (901, ""), (902, "tiny  ONE"), (None, items[5][1])]


def test_search_finds_all_above_the_threshold(exam):
    items, texts = exam
    index = decontamination.Index([(i, t) for i, t in items if t])
    draw = random.Random(1)
    for _ in range(400):
        query = set(draw.sample(sorted(index.lists), draw.randrange(1, 80)))
        if draw.random() < 0.5:
            query |= {index.term[t] for t in decontamination.tokens(draw.choice(items[:60])[1])}
        scores = collections.defaultdict(float)
        for t in query:
            for s, share in zip(*index.lists[t]):
                scores[s] += share
        expected = {s: x for s, x in scores.items() if x >= decontamination.THRESHOLD - 1e-9}
        assert index.search(query) == pytest.approx(expected)


def test_first_bound_lets_every_hit_through(exam):
    items, texts = exam
    index = decontamination.Index([(i, t) for i, t in items if t])
    split = [decontamination.tokens(t) for _, t in texts]
    passed = {(i, frozenset(q)) for i, q in index.passages(split)}
    for i, words in enumerate(split):
        for at in range(0, len(words), decontamination.SEGMENT):
            query = {index.term[t] for t in words[at : at + 2 * decontamination.SEGMENT] if t in index.term}
            if index.search(query):
                assert (i, frozenset(query)) in passed


@pytest.mark.parametrize("rows", [20_000, 7])
def test_contamination(spark, exam, rows):
    items, texts = exam
    docs = prepared(spark).createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    found = collections.Counter((r.doc_id, r.item_id) for r in decontamination.contamination(docs, bench, rows=rows).collect())
    assert max(found.values()) == 1
    for i, text in texts:
        for j, item in items:
            share = brute.five_word_share(text, item)
            if share == 1 and item:
                assert (i, j) in found, (i, j)
            elif share < decontamination.OVERLAP:
                assert (i, j) not in found, (i, j, share)
    kept = decontamination.keep_clean(docs, bench, rows=rows)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in texts if i not in {a for a, _ in found})


def test_results_do_not_depend_on_the_blocks(spark, exam):
    items, texts = exam
    docs = prepared(spark).createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole, parts = (sorted(map(str, decontamination.contamination(docs, bench, rows=rows).collect())) for rows in (20_000, 10))
    assert whole == parts and len(whole) > 50


def test_contamination_of_nothing(spark, exam):
    docs = prepared(spark).createDataFrame(exam[1], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (2, " ?! ")], "item_id long, text string")
    for bench in (none, none.limit(0)):
        assert decontamination.contamination(docs, bench).count() == 0
        assert decontamination.keep_clean(docs, bench).count() == len(exam[1])
    assert decontamination.contamination(docs.limit(0), none).schema["doc_id"].dataType.simpleString() == "bigint"


# Chat windows -------------------------------------------------------------------------

PIECES = ["\\", "#", "##", "###", "### ", "</turn>", "</turn>\n", "\n", ":", " ", ": ", "a", "B", "é", "𝒳", "### Assistant: ", "\\\\", ""]


def test_template_round_trip():
    draw = random.Random(3)
    for _ in range(3000):
        turns = [("".join(draw.choices(PIECES, k=draw.randrange(4))), "".join(draw.choices(PIECES, k=draw.randrange(8)))) for _ in range(3)]
        shown = [chat_windows.render(role, text) for role, text in turns]
        whole = "".join(s for s, _, _ in shown)
        read = list(chat_windows.parse(whole))
        assert [(role, text) for role, text, _, _ in read] == turns
        assert [chat_windows.unescape(whole[a:b]) for _, _, a, b in read] == [text for _, text in turns]


def conversation_rows():
    draw = random.Random(4)
    rows = []
    for conv in [*range(12), None]:
        if draw.random() < 0.6:
            rows.append((conv, 0, "system", "rules " * draw.randrange(9)))
        for turn in range(1, draw.randrange(2, 40)):
            text = draw.choice([None, "", "word " * draw.randrange(60), "### User: </turn>\n\\ " * 3])
            rows.append((conv, turn, draw.choice(["user", "assistant", "assistant", None, "Tool: x"]), text))
    rows += [(50, 1, "assistant", "same"), (50, 1, "assistant", "same"), (51, None, "user", "x " * 500), (52, 1, "assistant", "long " * 3000)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("budget, history", [(2048, 256), (60, 20), (50, 0)])
def test_windows_hold_every_turn_once(spark, budget, history):
    rows = conversation_rows()
    frame = prepared(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("mask", F.lit("x"))
    windows = chat_windows.windows(frame, budget, history)
    got = {r.conv: r for r in chat_windows.read_back(windows).collect()}
    by_conv = collections.defaultdict(list)
    for row in sorted(rows, key=lambda r: (str(r[0]), *((x is not None, x if x is not None else 0) for x in r[1:2]), *((x is not None, x or "") for x in r[2:]))):
        by_conv[None if row[0] is None else str(row[0])].append((row[2] or "", row[3] or ""))
    assert got.keys() == by_conv.keys()
    for conv, turns in by_conv.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    formed = windows.collect()
    for w in formed:
        turns = list(chat_windows.parse(w.text))
        fresh = turns[w.repeated:]
        assert fresh and sum(len(t.split()) for _, t, _, _ in turns) == w.n_tokens
        # Over the budget is just a turn that alone does not fit beside the system turn.
        assert w.n_tokens <= budget or len(fresh) == 1
        begins_with_system = by_conv[w.conv][0][0] == "system"
        if w.window and begins_with_system:
            assert turns[0][:2] == by_conv[w.conv][0]
        repeated = turns[1 if w.window and begins_with_system else 0 : w.repeated]
        assert sum(len(t.split()) for _, t, _, _ in repeated) <= history
        assert [(m.start, m.end) for m in w.mask] == [(a, b) for role, _, a, b in fresh if role == "assistant"]
    assert sum(r.formatted_chars for r in got.values()) == sum(len(w.text) for w in formed)


def test_runs_of_any_length_pass(spark):
    texts = [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "#" * 2_000_000, "a" + " \n" * 500_000 + "b", "7" * 2_000_000]
    rows = [(i, 0, "assistant", text) for i, text in enumerate(texts)]
    frame = prepared(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    windows = chat_windows.windows(frame, tokenizer="/opt/tokenizers/byte_bpe_50k.tiktoken")
    got = {int(r.conv): r for r in chat_windows.read_back(windows).collect()}
    for i, text in enumerate(texts):
        assert got[i].loss_chars == len(text) and got[i].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pieces_are_the_text():
    draw = random.Random(5)
    for text in ("", "x" * 9_999, "x" * 10_000, " " * 25_000, "".join(draw.choice([" ", "\n", "ab", "y" * 15_000]) for _ in range(40))):
        parts = chat_windows.pieces(text)
        assert "".join(parts) == text
        assert all(len(m) <= 2 * chat_windows.RUN for p in parts for m in re.findall(r"\s+|\S+", p))
    assert chat_windows.pieces("word " * 50_000) == ["word " * 50_000]


def test_many_empty_turns_do_not_pile_up(spark):
    frame = prepared(spark).range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.lit(None).cast("string").alias("text"))
    formed = chat_windows.windows(frame, 100, 20)
    assert max(len(r.mask) for r in formed.collect()) == 100 and max(r.repeated for r in formed.collect()) == 20
    assert [r.n_turns for r in chat_windows.read_back(formed).collect()] == [3000]


def test_no_conversations(spark):
    none = prepared(spark).createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_windows.read_back(chat_windows.windows(none)).count() == 0
    with pytest.raises(ValueError):
        chat_windows.windows(none, 10, 10)


def test_token_counter():
    count = chat_windows.counter("/opt/tokenizers/byte_bpe_50k.tiktoken")
    assert count(["", "hello world", "<|endoftext|>"]) == [0, 2, 7]


# Toxicity -----------------------------------------------------------------------------

def test_folding():
    assert toxicity.fold("Id!ot, 1D1OT! ｌоѕеｒ f​ool 2024 (v2)") == " idiot idiot ioser fooi 2024 vz "
    assert toxicity.fold(None) == toxicity.fold(" .,") == "  "


def toxic_corpus(n=1200):
    draw = random.Random(9)
    rows, truth = [], []
    for i in range(n):
        words = [draw.choice(VOCABULARY) for _ in range(draw.randrange(5, 80))]
        toxic = i % 6 == 0
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(["schmuck", "Schmуck", "SCHMUCK!", "grobianish", "grobianly", "gr0bianen"]))
        elif i % 6 == 1:
            at = draw.randrange(len(words))
            words[at:at] = ["gold", "schmuck"]
        rows.append((i, " ".join(words), "de", "s", 1))
        truth.append((i, 1, int(toxic)))
    return rows, truth


def test_learns_words_beginnings_and_exceptions(spark):
    rows, truth = toxic_corpus()
    docs = prepared(spark).createDataFrame(rows, brute.SCHEMA)
    labels = spark.createDataFrame(truth, "doc_id long, quality int, toxic int")
    scored = toxicity.score(docs, labels).collect()
    real = {i: t for i, _, t in truth}
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted == real[r.doc_id] for r in held) >= 0.97 * len(held)
    lexicon = toxicity.fit(docs, labels)
    assert lexicon.phrases == [" goid schmuck "]
    # Labels of held-out rows are not read: turning them round changes nothing.
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    assert toxicity.fit(docs, turned) == lexicon


def test_odd_rows_and_labels(spark, docs, clashing):
    labels = prepared(spark).createDataFrame([(1, 1, 0), (1, 1, 1), (5, 1, 1), (6, None, 0), (None, 1, 1), (8, 1, 7)], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, labels).collect()
    assert len(rows) == len(brute.DOCS) and not any(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    same(toxicity.score(docs, labels), toxicity.score(clashing, labels))
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0
