"""Operators over documents, against brute force on small tables."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from marquee.llm import fertility, jaccard, licences, mixing, packing, pitman_yor, quality, token_files
from marquee.llm.tokens import encoder, vocabulary
from marquee.session import run_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d"), (6, "a b c d"), (7, "ÄÖ é ́x 漢字 z"),
    (8, "word " * 30_000), (9, "w" * 20_000), (10, "<|endoftext|> x\x1cy  z\r\n  q"), (11, "A B C D"),
]


def sentences(seed, n, words=40, pool=400):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(pool)}" for _ in range(words)) for _ in range(n)]


# --- tokens -----------------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_whole_texts(name):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary(name))
    mine = encoder(vocabulary(name))
    rng = random.Random(3)
    letters = list("abS'stTd1,.! \n\t\x0b\x1c\x85\xa0́éß漢ΣİǄ|$#_ 　")
    texts = [t or "" for _, t in ODD] + ["".join(rng.choices(letters, k=rng.randint(0, 50))) for _ in range(4000)]
    special = ["<|endoftext|>", "<|startoftext|>", "<|", "<|endoftext", "|>", "<|ENDOFTEXT|>"]
    texts += ["".join(rng.choices([*special, *letters], k=rng.randint(0, 20))) for _ in range(2000)]
    texts += ["".join(rng.choices([" ", " ", "\n", "a", "Bé", ".", "\t"][: rng.randint(4, 7)], k=rng.randint(0, 12))) for _ in range(8000)]
    for text in texts:
        ids = np.frombuffer(mine.encode(text), mine.dtype).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text[:80]


def test_plain_spaces_are_cut_without_a_pattern(monkeypatch):
    from tokenizers import Tokenizer

    from marquee.llm import tokens

    path = vocabulary("byte_bpe_50k.json")
    whole, mine = Tokenizer.from_file(path), tokens.Encoder(path)
    searched = []

    class Pattern:
        def findall(self, text, pattern=tokens._KEEPING):
            searched.append(text)
            return pattern.findall(text)

    monkeypatch.setattr(tokens, "_KEEPING", Pattern())
    for text in ["one two, Three.\nfour\n\nfive été six\n", " a b ", "a  b", "a\n b", "a \n\t b", "a \n", "\n \n", "x\x1c y", "a\xa0 b c"]:
        ids = np.frombuffer(mine.encode(text), mine.dtype).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text
    searched.clear()
    text = " ".join(sentences(5, 9))
    assert mine.encode(text) and text not in searched


def test_token_files_round_trip(spark, docs_of):
    from tokenizers import Tokenizer

    rows = [*ODD, (4, "one more of the same key"), (None, "no key"), *enumerate(sentences(1, 40), 100)]
    folder = run_folder(spark, "test-token-files")
    docs = docs_of(*rows)
    token_files.write_token_files(docs, folder, shards=3)
    got = token_files.read_token_files(spark, folder, docs).collect()
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    start, want = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((r.key, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1]) == want
    found = {(r.key, r.copy): r.ids for r in token_files.lookup(spark, folder, [4, 101, 999_999, -5]).collect()}
    assert set(found) == {(4, 0), (4, 1), (101, 0)}
    assert found[4, 0] == [*tokenizer.encode("one", add_special_tokens=False).ids, 2]
    assert [len(token_files.get(spark, folder, k)) for k in (4, 101, 999_999, -5, 50)] == [2, 1, 0, 0, 0]
    for key in (8, 10, 139):
        ids = tokenizer.encode(dict(rows)[key], add_special_tokens=False).ids
        assert [g.tolist() for g in token_files.get(spark, folder, key)] == [[*ids, 2]]
    some = spark.createDataFrame([(101,), (101,), (50,), (None,)], "doc_id long")
    assert sorted(str(r.key) for r in token_files.read_token_files(spark, folder, some).collect()) == ["101", "None"]


def test_token_files_hold_no_keys_and_any_end_id(spark, docs_of):
    key = 0x0123456789ABCDEF
    folder = run_folder(spark, "test-token-files")
    token_files.write_token_files(docs_of((key, "one two"), (5, "x"), (key + 9, "y")), folder, end_id=50_256, shards=1)
    content = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(folder).collect())
    # the footer names its first and last key only
    assert key.to_bytes(8, "little") not in content
    assert [g.tolist()[-1] for g in token_files.get(spark, folder, key)] == [50_256]
    assert token_files.lookup(spark, folder, [key]).collect()[0].ids[-1] == 50_256


def test_one_probe_reads_as_many_bytes_of_a_large_index():
    rng = np.random.RandomState(2)
    for n in (1_000, 300_000):
        keys = np.unique(rng.randint(-(1 << 62), 1 << 62, n))
        table, read = token_files.PerfectHash.build(keys), []
        data, slots = table.to_bytes(), table.slots(keys)
        for i in range(0, n, n // 50):
            read.append(0)

            def some(at, size):
                read[-1] += size
                return data[at : at + size]

            assert token_files.PerfectHash.probe(keys[i : i + 1], some) == slots[i]
        assert max(read) < 1_500


def test_token_files_of_an_empty_table(spark, docs_of):
    folder = run_folder(spark, "test-token-files")
    docs = docs_of().where("false")
    token_files.write_token_files(docs, folder)
    assert token_files.read_token_files(spark, folder, docs).count() == 0
    assert token_files.get(spark, folder, 3) == [] and token_files.lookup(spark, folder, [3]).count() == 0


def test_perfect_hash_is_minimal_and_tells_foreign_keys():
    rng = np.random.RandomState(1)
    keys = np.unique(rng.randint(-(1 << 62), 1 << 62, 20_000))
    table = token_files.PerfectHash.from_bytes(memoryview(token_files.PerfectHash.build(keys).to_bytes()))
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    prints = np.empty(len(keys), "<u4")
    prints[table.slots(keys)] = table.fingerprints(keys)
    foreign = np.setdiff1d(rng.randint(-(1 << 62), 1 << 62, 20_000), keys)
    slot = table.slots(foreign)
    wrong = (slot >= 0) & (prints[slot] == table.fingerprints(foreign))
    assert wrong.sum() <= 1


# --- packing ----------------------------------------------------------------------


@pytest.mark.parametrize("fan_in", [64, 2])
def test_packing_places_every_id_once(spark, docs_of, fan_in):
    rows = [*ODD, (4, "one"), (None, "no key"), *enumerate(sentences(2, 300, 120), 100)]
    docs = docs_of(*rows).repartition(7)
    got = packing.pack(docs, capacity=1024, fan_in=fan_in).collect()
    mine = encoder(vocabulary("word_bpe_49k.json"))
    ids_of = collections.defaultdict(list)
    for key, text in rows:
        ids_of[key].append(np.append(np.frombuffer(mine.encode(text or ""), mine.dtype), 2).astype("<u4"))
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for key, copies in ids_of.items():
        if len(copies) == 1:
            at = 0
            for start, length, crc, total in sorted(pieces[key]):
                assert start == at and total == len(copies[0])
                assert crc == zlib.crc32(copies[0][start : start + length].tobytes())
                at += length
            assert at == len(copies[0])
    assert sum(r.length for r in got) == sum(len(c) for copies in ids_of.values() for c in copies)
    windows = collections.defaultdict(list)
    for r in got:
        windows[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 0.02 * sum(r.length for r in got)


def test_packing_an_empty_table(docs_of):
    assert packing.pack(docs_of().where("false")).count() == 0


# --- Jaccard join -------------------------------------------------------------------


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_copies(seed):
    rng = random.Random(seed)
    texts = []
    for base in sentences(seed, 12, 60):
        for _ in range(8):
            words = base.split()
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(words[: rng.choice([60, 60, 52, 45])]))
    passage = " ".join(f"p{i}" for i in range(50))
    texts += [f"{s} {passage}" for s in sentences(seed + 1, 10, 30)]
    return texts


def links_of(sets, i):
    return sum(
        100 * len(sets[i] & s) >= 75 * len(sets[i] | s) for j, s in enumerate(sets) if j != i and s and sets[i]
    )


def components_of(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingle_set(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return sets, list(groups.values())


@pytest.mark.parametrize("block, shingles", [(8192, 4_000_000), (4, 400)])
def test_jaccard_components_match_brute_force(docs_of, monkeypatch, block, shingles):
    monkeypatch.setattr(jaccard, "CELL_BLOCK", block)
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", shingles)
    rows = [*ODD, *enumerate(near_copies(5), 100)]
    random.Random(9).shuffle(rows)
    found = jaccard.jaccard_components(docs_of(*rows)).collect()
    sets, groups = components_of(rows)
    want = {rows[i][0]: (len(sets[i]), min(rows[j][0] for j in g), links_of(sets, i)) for g in groups for i in g}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found} == want
    assert max(r.n_links for r in found) > 5


@pytest.mark.parametrize("block, shingles", [(8192, 4_000_000), (64, 2000)])
def test_links_of_one_large_group_of_near_copies(docs_of, monkeypatch, block, shingles):
    """A third of the rows are copies of one text; some differ so much that
    they link with a part of the group only."""
    monkeypatch.setattr(jaccard, "CELL_BLOCK", block)
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", shingles)
    rng = random.Random(4)
    base, texts = sentences(8, 1, 80, 4000)[0].split(), []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4])):
            words[rng.randrange(80)] = f"x{rng.randrange(9999)}"
        texts.append(" ".join(words))
    rows = [*enumerate(texts), *enumerate(sentences(9, 300, 60), 1000), (5, texts[7]), (None, texts[3])]
    found = jaccard.jaccard_components(docs_of(*rows)).collect()
    sets, groups = components_of(rows)
    want = [
        (rows[i][0], min(rows[j][0] for j in g if rows[j][0] is not None), links_of(sets, i)) for g in groups for i in g
    ]
    assert sorted(((r.doc_id, r.component_id, r.n_links) for r in found), key=str) == sorted(want, key=str)
    assert len({r.n_links for r in found}) > 10


def test_overlaps_by_differences_are_those_of_whole_sets():
    rng = np.random.RandomState(5)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(rng.permutation(base)[: 100 - rng.randint(30)]) for _ in range(20)]
    sets += [np.sort(rng.choice(400, rng.randint(1, 120), replace=False)).astype(np.uint64) for _ in range(20)]
    sets += [base, np.array([3], np.uint64), base + np.uint64(1000)]
    held = jaccard._Sets(sets)
    for i, a in enumerate(sets):
        want = [100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)) for b in sets]
        assert held.linked(i).tolist() == want


def test_one_document_of_each_group_stays(docs_of):
    rows = [*ODD, (5, "a b c d"), (5, "quite another text of this key"), (None, "a b c d"), (None, "lonely"), (None, "lonely"),
            *enumerate(near_copies(6), 100)]
    docs = docs_of(*rows)
    got = jaccard.first_of_each(docs)
    assert got.columns == docs.columns
    _, groups = components_of(rows)
    want = []
    for g in groups:
        keyed = sorted((rows[i] for i in g if rows[i][0] is not None), key=lambda r: r[0])
        want.append((keyed or [rows[g[0]]])[0])
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_jaccard_of_an_empty_table(docs_of):
    assert jaccard.jaccard_components(docs_of().where("false")).count() == 0


# --- quality rules --------------------------------------------------------------------


def test_base_counts_match_brute_force(docs_of):
    rows = [*ODD, (20, "x y z x y z\n\nline\nline \nline\n# $ <a>|&%*"), (21, "a a a a"), (22, "é " * 60),
            *enumerate(sentences(4, 60, 90), 100)]
    got = {r.doc_id: r for r in fertility.judge(docs_of(*rows)).collect()}
    assert len(got) == len(rows)
    for key, text in rows:
        text = text or ""
        words = WORD.findall(text)
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = {t for t, n in collections.Counter(triples).items() if n > 1}
        covered = {j for i, t in enumerate(triples) if t in often for j in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[key]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == len(covered)
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.base_failed and r.kept)
    assert all(r.kept for r in got.values() if r.doc_id >= 100)


def test_rules_keep_clean_documents_and_reject_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = fertility.judge(docs, keep=["doc_id"]).join(labels, "doc_id").where("not base_failed").collect()
    share = {q: np.mean([r.kept for r in rows if r.quality == q]) for q in (0, 1)}
    assert share[1] > 0.99 and share[0] < 0.5


def test_near_copies_do_not_narrow_the_bands(spark, docs_of):
    """A near-copy group fills most of one length class of the language."""
    plain = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1"), "doc_id")
    rows = {r.doc_id: r.text for r in plain.where("lang = 'en'").orderBy("doc_id").limit(1500).select("doc_id", "text").collect()}
    alone = {r.doc_id: r for r in fertility.judge(docs_of(*rows.items())).collect()}
    octaves = collections.Counter(r.n_tokens.bit_length() for r in alone.values() if r.kept)
    full = octaves.most_common(1)[0][0]
    clean = [k for k, r in alone.items() if r.kept and r.n_tokens.bit_length() == full]
    # the text with the most characters per token has its near copies
    words = rows[max(clean, key=lambda k: alone[k].chars_per_token)].split()
    rng = random.Random(3)
    copies = []
    for i in range(3 * len(clean)):
        changed = list(words)
        for _ in range(2):
            changed[rng.randrange(len(words))] = rng.choice(words)
        copies.append((1_000_000_000 + i, " ".join(changed)))
    got = {r.doc_id: r.kept for r in fertility.judge(docs_of(*rows.items(), *copies)).collect()}
    lost = [k for k in clean if not got[k]]
    assert len(lost) <= 0.01 * len(clean)


def test_rules_on_an_empty_table(docs_of):
    assert fertility.judge(docs_of().where("false")).count() == 0


# --- quality classifier ---------------------------------------------------------------


def test_classifier_is_accurate_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    good = [r.score for r in rows if r.quality == 1]
    junk = [r.score for r in rows if r.quality == 0]
    assert np.mean([a > b for a in good for b in junk]) > 0.97


def test_classifier_edge_cases(spark, docs_of):
    docs = docs_of(*ODD, (4, "one"), (None, "no key"))
    labels = spark.createDataFrame([(1, 1), (4, None), (4, 0), (None, 1)], "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == len(ODD) + 2
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert {r.doc_id: r.held_out for r in rows}[4] == (zlib.crc32(b"4") % 5 == 0)
    assert quality.classify(docs.where("false"), labels.where("false")).count() == 0


# --- language model -----------------------------------------------------------------------


def test_pitman_yor_base_and_score(docs_of):
    rows = [*ODD, (4, "one"), (None, "no key"), *enumerate(sentences(7, 150, 60, 900), 100)]
    got = pitman_yor.score(docs_of(*rows)).collect()
    counts = collections.Counter()
    tokens = {}
    for key, text in rows:
        words = [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]
        tokens.setdefault(key, words)
        if zlib.crc32(("" if key is None else str(key)).encode()) % 7 != 2:
            counts.update(words)
    total, kinds = sum(counts.values()), len(counts)
    assert sorted((str(r.doc_id) for r in got)) == sorted(str(k) for k, _ in rows)
    for r in got:
        words = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        assert r.train_tokens == total and r.n_tokens == len(words)
        assert r.n_known == sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    unseen = [r for r in got if r.held_out and r.n_tokens > 20 and r.n_known > 0.5 * r.n_tokens]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_pitman_yor_probabilities_add_up_to_one():
    rng = np.random.RandomState(2)
    n_words = 300
    word = np.minimum(rng.zipf(1.5, 9000) - 1, n_words - 1)
    contexts = np.arange(pitman_yor.START, pitman_yor.RESTAURANTS)
    restaurant = contexts[rng.randint(0, 5, len(word)) * 7 % len(contexts)]
    pair, customers = np.unique(word * pitman_yor.RESTAURANTS + restaurant, return_counts=True)
    present = np.unique(pair // pitman_yor.RESTAURANTS)
    entries = np.bincount(np.searchsorted(present, pair // pitman_yor.RESTAURANTS))
    batch = {"entries": entries.astype(np.uint8), "restaurant": (pair % pitman_yor.RESTAURANTS).astype(np.uint8),
             "customers": customers.astype(np.uint64), "words": present.astype(np.uint64)}
    import pyarrow as pa

    columns = {"bucket": pa.array([0]), **{k: pitman_yor._packed(v) for k, v in batch.items()}}
    model = pitman_yor.Model(len(present), 0.6)
    seating = pitman_yor.Seating(entries, batch["restaurant"], customers)
    model.settle([dict(zip(("all_customers", "all_tables"), seating.totals()))])
    seats = next(pitman_yor._gibbs(model, iter([pa.record_batch(columns)])))
    model.settle(seats.select(["all_customers", "all_tables"]).to_pylist())
    held = pitman_yor.Seats(seats.to_pylist()[0])
    for r in contexts[:9]:
        index = np.append(np.arange(len(present)), -1)  # all words, and an unseen one
        p = held.probabilities(model, index, np.full(len(index), r))
        assert p.sum() == pytest.approx(1, abs=1e-9) and (p > 0).all()


@pytest.mark.parametrize("customers", [2, 3, 6, 60])
def test_pitman_yor_seats_have_their_posterior(customers):
    room, d, p = 2.0, 0.6, 0.3
    # joint weights of all seatings, by number of tables, customer by customer
    law = np.zeros(customers + 2)
    law[1] = 1
    tables = np.arange(customers + 2)
    for seated in range(1, customers):
        stay, opened = law * (seated - d * tables), law * (room + d * tables) * p
        law = np.where(tables <= seated, stay, 0) + np.append(0, opened[:-1])
        law /= law.sum()
    n, rng, found = 6000, np.random.RandomState(4), np.zeros(customers + 2)
    full = lambda x: np.full(n, x)
    # a third of the customers come later, and some leave again
    seats = pitman_yor.Arrivals(full(max(customers * 2 // 3, 1)))
    seats.sit_again(full(customers + 2), full((room - 1) / d), full(d), full(p), rng)
    for sweep in range(200):
        t = seats.sit_again(full(customers), full((room - 1) / d), full(d), full(p), rng)
        if sweep >= 50:
            found += np.bincount(t.astype(int), minlength=customers + 2)
    found /= found.sum()
    assert np.abs(found - law).max() < 0.01 and found @ tables == pytest.approx(law @ tables, rel=0.02)


def test_reader_keeps_words_over_many_texts():
    reader = pitman_yor._Reader()
    texts = sentences(6, 60, words=50, pool=4000)
    seen = [(text.split(), *reader.tokens(text)) for text in texts]
    hashes = []
    for words, ids, restaurant in seen:
        hashes += reader.hashes[ids].tolist()
        alone = pitman_yor._Reader()
        own, own_restaurant = alone.tokens(" ".join(words))
        assert reader.hashes[ids].tolist() == alone.hashes[own].tolist()
        assert restaurant.tolist() == own_restaurant.tolist()
    assert len(set(hashes)) == reader.known


def test_pitman_yor_knows_two_preceding_words(docs_of):
    """A held-out copy of a training text is told word by word, the same words in
    another order are not."""
    rng = np.random.RandomState(5)
    words = np.array([f"w{i}" for i in range(3000)])
    rows = [(i, " ".join(words[rng.randint(0, 3000, 60)])) for i in range(400) if zlib.crc32(str(i).encode()) % 7 != 2][:40]
    held_out = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 7 == 2]
    copied = rows[3][1].split()
    rows += [(held_out[0], " ".join(copied)), (held_out[1], " ".join(rng.permutation(copied)))]
    got = {r.doc_id: r for r in pitman_yor.score(docs_of(*rows)).collect()}
    same, shuffled = (got[k].score / got[k].n_tokens for k in held_out[:2])
    assert got[held_out[0]].held_out and same > -1.5 and shuffled < -2
    assert got[held_out[0]].base_score == pytest.approx(got[held_out[1]].base_score)


def test_pitman_yor_first_totals():
    rng = np.random.RandomState(8)
    pair = np.unique(rng.randint(0, 40, 300) * pitman_yor.RESTAURANTS + rng.randint(pitman_yor.START, pitman_yor.RESTAURANTS, 300))
    word, restaurant = np.unique(pair // pitman_yor.RESTAURANTS, return_inverse=True)[1], pair % pitman_yor.RESTAURANTS
    customers = rng.randint(1, 9, len(pair))
    want = pitman_yor.Seating(np.bincount(word), restaurant, customers).totals()
    got = pitman_yor._first_totals(word, restaurant, customers)
    assert all(w.tolist() == g.tolist() for w, g in zip(want, got))


def test_pitman_yor_contexts_add_up_to_one():
    """All words in the restaurants of some pairs of words, whether seen there or not."""
    rng = np.random.RandomState(3)
    n_words, firsts, seconds = 200, 5, 4
    first, second, word = np.meshgrid(np.arange(firsts), np.arange(seconds), np.arange(n_words), indexing="ij")
    pair_of = (first * n_words + word).ravel()
    customers = np.where(rng.random_sample(pair_of.shape) < 0.2, rng.zipf(1.6, pair_of.shape), 0).clip(0, 500)
    customers[(second == 3).ravel()] = 0  # two words that no training text has
    seated = pitman_yor.Contexts(pair_of, (first * seconds + second).ravel(), customers, np.repeat(np.arange(firsts), n_words))
    p = np.tile(rng.dirichlet(np.ones(n_words)), firsts)
    sums, discounts = [np.zeros(firsts * n_words), np.zeros(len(pair_of)), np.zeros(firsts * n_words)], (0.7, 0.5)
    for _ in range(4):
        seated.sweep(discounts, p, p, rng)
        assert (seated.tables[0] <= seated.tokens).all() and (seated.tables[1] <= seated.customers).all()
        assert (seated.customers == np.bincount(pair_of, seated.tables[0])).all()
        assert ((seated.tables[0] > 0) == (customers > 0)).all()
        for total, x in zip(sums, (seated.customers, *seated.tables)):
            total += x / 4
    got = seated.probabilities(discounts, p, sums[0], sums[1:])
    assert (got > 0).all() and np.abs(np.bincount(seated.context, got) - 1).max() < 1e-9


def test_pitman_yor_of_an_empty_table(docs_of):
    assert pitman_yor.score(docs_of().where("false")).count() == 0


# --- mixing ------------------------------------------------------------------------------------


def targets_by_rounds(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_meets_its_targets(docs_of):
    rng = random.Random(8)
    names = ["b", "a", None, "ä", "c", "empty"]
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 60))), rng.choice(names[:5] + ["a"] * 4)) for i in range(3000)]
    rows += [(9001, None, "empty"), (9002, "  ", "empty"), (None, "no key here", "a"), (9003, "twice this row", "c"), (9003, "twice this row", "c")]
    docs = docs_of(*rows)
    got = mixing.mix(docs, keep=["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets_by_rounds(dict(sizes))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    again = mixing.mix(docs.repartition(5), keep=["doc_id", "source"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    repeated = mixing.repeat_rows(docs)
    assert repeated.columns == docs.columns
    assert repeated.count() == sum(r.copies for r in got)


def test_mix_prefers_heavier_documents(docs_of):
    docs = docs_of(*[(i, "w w w", f"s{i % 3}") for i in range(2000)]).selectExpr("*", "if(doc_id < 1000, 3.0D, 1.0D) as heavy")
    got = mixing.mix(docs, weight="heavy").where("source_size > target").collect()
    heavy = sum(r.copies for r in got if r.doc_id < 1000)
    assert heavy > 1.4 * sum(r.copies for r in got if r.doc_id >= 1000)


def test_mix_includes_by_its_odds(docs_of):
    """Over many seeds a document is drawn about as often as its p says."""
    rng = random.Random(4)
    docs = docs_of(*[(i, "w " * rng.choice([4, 16, 36]), f"s{i % 3}") for i in range(1500)]).cache()
    seeds = range(4)
    drawn = collections.defaultdict(list)
    for seed in seeds:
        for r in mixing.mix(docs, seed=seed, keep=["doc_id", "source"]).collect():
            drawn[r.source, r.size].append((r.copies - math.floor(r.target / r.source_size), r.p))
    odds = set()
    for got in drawn.values():
        p = got[0][1]
        odds.add(p)
        assert sum(n for n, _ in got) / len(got) == pytest.approx(p, abs=0.06)
    assert len(odds) > 5  # they differ inside a source


def test_mix_divides_rows_that_tie(docs_of):
    """Rows without key and with the same text share a draw, not their lot."""
    rows = [(None, "w " * 20, "s1")] * 6000 + [(i, "w " * 20, "s0") for i in range(6000)]
    rows += [(7, "w " * 20, "s2")] * 6000
    got = mixing.mix(docs_of(*rows).repartition(5), keep=["doc_id", "source"]).collect()
    assert len(got) == len(rows)
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 10 for s in target)


def test_mix_of_an_empty_table_and_of_empty_texts(docs_of):
    assert mixing.mix(docs_of().where("false")).count() == 0
    got = mixing.mix(docs_of((1, None), (2, ""))).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2


# --- licences --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def classifier():
    return licences.Classifier()


@pytest.mark.parametrize("text, family", [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This file is available under the Apache License, Version 2.0, see below", "apache-2.0"),
    ("Copyright (c) 2019 Example GmbH. All rights reserved.", "all-rights-reserved"),
    ("Note: released under the MIT licence by its authors", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("The driver's license of the witness had expired", "unknown"),
    ("Das Brot mit Butter schmeckt", "unknown"),
    ("Text and figures: CC BY-NC-SA 4.0", "cc-by-nc-sa"),
    ("Licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "cc-by-nd"),
    ("Creative Commons Attribution Non-Commercial Share-Alike license", "unknown"),
    ("This project is not licensed under the MIT license", "unknown"),
    ("The code is no longer distributed under the Apache License, Version 2.0", "unknown"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("Distributed under the Boost Software License, Version 1.0.", "boost"),
    ("In no event will the authors be held liable for any damages arising from the use of this software.", "zlib"),
    ("are made available under the terms of the Eclipse Public License v2.0 which is available at", "epl"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", "public-domain"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", "ofl"),
    ("SPDX-License-Identifier: LGPL-2.1", "lgpl"),
    ("SPDX-License-Identifier: CC0-1.0", "public-domain"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed", "mpl"),
    ("you may not use it except under the terms of the Apache License 2.0", "apache-2.0"),
    ("the python and the eclipse plugin were released", "unknown"),
    ("Under a license of our own", "unknown"),
])
def test_licence_families(classifier, text, family):
    assert classifier.classify(licences.features(text))[0] == family


def test_licence_probabilities_hold_for_unseen_wordings(classifier):
    p, y = classifier.unseen
    top, right = p.max(1), p.argmax(1) == y.argmax(1)
    assert abs(top.mean() - right.mean()) < 0.1
    assert 0.3 < classifier.temperature < 5 and 0.5 <= classifier.least <= 0.9
    assert right[top >= 0.5].mean() > 0.7 > 0.5 > right[top < 0.5].mean()


def test_no_licence_is_taken_for_a_more_permissive_one(classifier):
    """Whatever conditions are written, in whatever form: their family or none."""
    for held in ((), ("nc",), ("nd",), ("sa",), ("nc", "nd"), ("nc", "sa")):
        family = "-".join(["cc-by", *held])
        long = {"nc": "NonCommercial", "nd": "NoDerivatives", "sa": "ShareAlike"}
        spaced = {"nc": "Non-Commercial", "nd": "No Derivatives", "sa": "Share Alike"}
        for text in (
            f"licensed under CC BY{''.join('-' + c.upper() for c in held)} 4.0", f"CC-BY{''.join('-' + c.upper() for c in held)} 3.0",
            f"Creative Commons Attribution{''.join('-' + long[c] for c in held)} 4.0 International License",
            f"a Creative Commons Attribution {' '.join(spaced[c] for c in held)} license",
        ):
            assert classifier.classify(licences.features(text))[0] in (family, "unknown"), text
    lesser = licences.features("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation")
    assert "gpl" not in classifier.families(lesser)


def test_licence_scan_rows(docs_of):
    docs = docs_of(*ODD, (30, "intro\nReleased under the MIT License.\ntext\nAll rights reserved.\nReleased under the MIT License."),
                   (30, "the license plate"), (None, "Licensed under the Apache License, Version 2.0."))
    got = licences.scan(docs).collect()
    assert len(got) == len(ODD) + 3
    by_hits = sorted((r.doc_id, r.n_licences, r.families) for r in got if r.n_licences and r.doc_id)
    assert by_hits == [(30, 3, "all-rights-reserved,mit")]
    assert [r.families for r in got if r.doc_id is None] == ["apache-2.0"]
    assert licences.scan(docs.where("false")).count() == 0


@pytest.mark.parametrize("text, families", [
    ("// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the following\n//", "bsd"),
    (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n"
     " * the Free Software Foundation, either version 3 of the License, or", "gpl"),
    ("dnl Permission is hereby granted,\ndnl free of charge, to any\ndnl person obtaining a\ndnl copy of this software", "mit"),
    ("# Licensed under the\n# Apache License,\n# Version 2.0 (the License);", "apache-2.0"),
    ("Dual-licensed under the MIT license or the Apache License, Version 2.0", "apache-2.0,mit"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "apache-2.0,mit"),
    ("Licensed under the GNU Affero General Public License, version 3", "agpl"),
    ("This work is licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("Released under the\n\nMIT License went the old heading", ""),
])
def test_wrapped_and_dual_notices(docs_of, text, families):
    (row,) = licences.scan(docs_of((1, f"words before\n\n{text}\n\nwords after"))).collect()
    assert (row.families, row.n_licences) == (families, int(bool(families)))
