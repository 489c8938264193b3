"""Document operators against plain statements of their results."""

import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest

from pressloom.llm import decontaminate, language, ngram_join, pack, pii, quality_rules, queries, site_quality, token_count

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def near_texts():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(300)}"
    base = [word() for _ in range(60)]
    texts = []
    for _ in range(150):  # near copies
        own = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
            own[rng.randrange(60)] = f"u{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts += [" ".join(base[:20] + [f"z{rng.randrange(10**6)}" for _ in range(40)]) for _ in range(40)]  # a shared passage
    texts += [" ".join(f"c{j}" for j in range(3 * i, 3 * i + 60)) for i in range(50)]  # a chain
    texts += [texts[7]] * 30 + [None, "", "a b", "A  b", "a b c"]
    return list(enumerate(texts))


@pytest.mark.parametrize(("k", "percent", "list_size", "batch"), [(4, 85, 64, 10_000), (4, 85, 4, 3), (5, 80, 1000, 7)])
def test_clusters_equal_brute_force(spark, k, percent, list_size, batch):
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = ngram_join.clusters(docs, k, percent, list_size=list_size).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.clusters(rows, k, percent)


def test_op1_on_the_given_table(spark, small):
    got = queries.op1_ngram_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.clusters(pairs(small("documents")), 4, 85)


def test_clusters_of_rows_that_share_one_id_and_are_repeated(spark):
    rows = near_texts()
    plain = brute.clusters(rows, 4, 85)
    ids = {i: i if i % 3 == 0 else 500 for i, _ in rows}
    least = {}
    for i, (_, component) in plain.items():
        least[component] = min(ids[i], least.get(component, ids[i]))
    want = sorted((ids[i], n, least[component]) for i, (n, component) in plain.items())
    docs = spark.createDataFrame([(ids[i], t) for i, t in rows], "doc_id long, text string")
    got = ngram_join.clusters(docs.unionAll(docs).repartition(5), 4, 85, list_size=8).collect()
    assert sorted(map(tuple, got)) == sorted(want + want)


def test_clusters_of_odd_rows(spark, odd):
    got = ngram_join.clusters(odd, 4, 85).collect()
    assert len(got) == odd.count()
    expected = brute.clusters([(i, t) for i, t in pairs(odd) if i is not None], 4, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == expected
    assert ngram_join.clusters(odd.limit(0)).count() == 0


def test_prefix_bound_is_never_too_high():
    """Any two sets that are similar enough share what the prefixes demand."""
    rng = np.random.default_rng(3)
    sketch = np.zeros(1 << 10, np.uint32)
    pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
    for _ in range(300):
        n = int(rng.integers(5, 120))
        x = np.unique(rng.choice(pool, n))
        y = np.unique(np.concatenate([rng.choice(x, max(1, len(x) - int(rng.integers(0, 12))), replace=False), rng.choice(pool, int(rng.integers(0, 9)))]))
        both = len(np.intersect1d(x, y))
        np.add.at(sketch, (x & np.uint64(1023)).astype(int), 1)
        if 185 * both < 85 * (len(x) + len(y)):
            continue
        (p, _), (q, _) = (ngram_join.prefix(s, sketch, float(sketch.mean()), 85) for s in (x, y))
        overlap = -(-85 * (len(x) + len(y)) // 185)
        assert len(np.intersect1d(p, q)) >= max(1, overlap + min(len(p) - len(x), len(q) - len(y)))
        assert ngram_join.differing(ngram_join.parity(x), ngram_join.parity(y)) <= len(x) + len(y) - 2 * both


@pytest.mark.parametrize("cut", [False, True])
def test_possible_pairs_are_those_that_sizes_and_bitmaps_allow(cut):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 140, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: int(rng.integers(20, 141))], rng.integers(0, 2**64, int(rng.integers(0, 20)), dtype=np.uint64)])) for _ in range(120)]
    n, groups, side = np.array([len(s) for s in sets]), rng.integers(0, 60, 120), rng.integers(0, 2, 120)
    bitmaps = [ngram_join.parity(s) for s in sets]
    got = ngram_join.possible_pairs(n, groups, bitmaps, 80, side if cut else None)
    most = lambda i, j: n[i] + n[j] - 2 * -(-80 * (n[i] + n[j]) // 180)
    fits = lambda i, j: 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j]) and ngram_join.differing(bitmaps[i], bitmaps[j]) <= most(i, j)
    want = {(i, j) for i in range(120) for j in range(i) if groups[i] != groups[j] and (not cut or side[i] != side[j]) and fits(i, j)}
    assert sorted((max(p), min(p)) for p in zip(*map(np.ndarray.tolist, got), strict=True)) == sorted(want) and want


def test_sets_of_unlike_texts_with_a_shared_passage_do_not_travel(spark, monkeypatch):
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    own = lambda size: [f"o{rng.randrange(10**9)}" for _ in range(size)]
    texts = [" ".join(own(half := rng.randrange(13)) + passage + own(12 - half)) for _ in range(150)]
    texts += [t.rsplit(" ", 1)[0] + f" end{i}" for i, t in enumerate(texts[:20])]
    rows, taken, fetched = list(enumerate(texts)), [], []
    blocks, sets = ngram_join._blocks, ngram_join._fetched
    monkeypatch.setattr(ngram_join, "_blocks", lambda lists, *rest: taken.append(lists.count()) or blocks(lists, *rest))
    monkeypatch.setattr(ngram_join, "_fetched", lambda *given: fetched.append(sets(*given)) or fetched[-1])
    counts = []
    dropped = ngram_join.dropped
    monkeypatch.setattr(ngram_join, "dropped", lambda table: (counts.append(table.count()) if any(table is f for f in fetched) else None) or dropped(table))
    got = ngram_join.clusters(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, list_size=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.clusters(rows, 5, 80)
    assert taken == [0] and counts[-1] <= 60


def test_quality_base_rules(spark, small, odd):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(150)] + ["a \x0b b\n\n \nc\nc"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs in (made, small("documents"), odd.filter("doc_id is not null")):
        got = quality_rules.scored(docs).collect()
        assert len(got) == docs.count()
        base = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got}
        assert base == {i: brute.quality_base(t) for i, t in pairs(docs)}
        assert all(0 <= r.quality <= 1 and not (r.kept and r.base_failed) for r in got)
    assert quality_rules.scored(odd.limit(0)).count() == 0


def test_quality_rules_keep_clean_and_drop_noisy_documents(spark):
    rng = random.Random(2)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.choice('aeiou')}" for _ in range(200)]
    clean = ["\n".join(" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(8)) for _ in range(300)]
    noisy = [" ".join(rng.choice(words).upper() + rng.choice(["!!!", "###", "%%%"]) for _ in range(90)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(clean + noisy)), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_rules.scored(docs).collect()}
    assert all(kept[i] for i in range(300)) and not any(kept[i] for i in range(300, 340))


def test_private_spans_equal_regular_expressions(spark, small, odd):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab1@.+-( )2345%é") for _ in range(rng.randrange(1, 80))) for _ in range(300)]
    texts += ["é a@b.c a%b@c.d%d@e.f x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 1..2.3.4", "4111 1111 1111 1111 4111-1111-1111-1111-1 " + "1 " * 3000]
    texts += ["+1 (234) 567-8901 +12 ++123456789012 +1-.-.-. +1234567890123456", "a" * 30000 + " " + "1." * 2000 + "@" * 50, "x@y.z " * 1000]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs in (made, small("documents"), odd.filter("doc_id is not null")):
        got = pii.report(docs).collect()
        assert len(got) == docs.count()
        assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got} == {i: brute.private(t) for i, t in pairs(docs)}
    assert pii.report(odd.limit(0)).count() == 0


def test_terms_that_reveal_an_entity_are_found_and_others_left(spark):
    rng = random.Random(4)
    common = [f"{a}{b}{c}" for a in "bcd" for b in ("ala", "oro", "emi") for c in "nst"]
    texts = [" ".join(rng.choice(common) for _ in range(20)) for _ in range(300)]
    texts += [" ".join(rng.choice(common) for _ in range(9)) + " Zorblatt ann@example.org " + " ".join(rng.choice(common) for _ in range(9)) for _ in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("text_key", pii.F.lit(1))
    got = {r.doc_id: r.spans for r in pii.report(docs).collect()}
    for i, text in enumerate(texts):
        at = text.find("Zorblatt")
        assert got[i] == ("" if at < 0 else f"email:{at + 9}:{at + 24},removed:{at}:{at + 8}")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all(clean[i] == texts[i] for i in range(300))
    assert all("Zorblatt" not in clean[i] and "<EMAIL>" in clean[i] and "ann@" not in clean[i] for i in range(300, 312))


@pytest.mark.parametrize("others", [300, 30_000])
def test_terms_reveal_an_entity_whatever_the_size_of_the_corpus(spark, others):
    """Far from it, in two texts, in long runs of letters; rare terms of one text or of other texts stay."""
    common = "alpha beta gamma delta " * 6
    long = "Zorblatt" * 5
    texts = [f"some common word {i}" for i in range(others)]
    texts += [f"Quenby {common} ann@example.org", f"{common} ann@example.org {common} quenby"]
    texts += [f"{long} {common} x{i} bob@example.net" for i in range(3)] + [f"Quenbyx {common}", "tuskar@example.com tuskar"]
    texts += ["Remarkable zebrafish aquaria newsletter: write to info@example.edu"]
    texts += [f"MEGACORP desk {i} {w} +1 555 02{i} 7{i}7{i}" for i, w in enumerate(["unu", "duo", "tri", "kva", "kvi", "ses", "sep", "oka"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id - others: r.spans for r in pii.report(docs).collect()}
    assert not any(got[i] for i in range(-others, 0)) and got[5] == ""
    for i in (0, 1):
        mail, name = texts[others + i].find("ann@"), texts[others + i].lower().find("quenby")
        assert got[i] == f"email:{mail}:{mail + 15},term:{name}:{name + 6}"
    assert all(got[i].endswith(",term:0:40") for i in (2, 3, 4))
    assert got[6] == "email:0:18" and got[7] == "email:50:66"
    assert all(got[i].startswith("phone:") and ",removed:0:8,removed:9:13" in got[i] for i in range(8, 16))
    clean = {r.doc_id - others: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0].startswith("<NAME> alpha") and clean[1].endswith(" <WORD>")


def test_overlapping_spans_are_replaced_whole(spark):
    texts = ["+1 (555) 123-4567.user@x.com", "4111 1111 1111 1111@x.com", "a +4111 1111 1111 1111 b", "x@y.zz x@y.zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.text for r in pii.sanitise(docs).orderBy("doc_id").collect()] == ["<PHONE>", "<CARD>", "a +<CARD> b", "<EMAIL> <EMAIL>"]


def plain_terms(rows, least=0.5, remove=0.8, bits=3, doubt=1.64):
    """{term: kind} by counting; rows of (text, entities, terms) without copies."""
    out = {}
    for term in set().union(*(t for _, _, t in rows)):
        own = [e for _, e, t in rows if term in t]
        for entity in set().union(*own):
            n = sum(entity in e for e in own)
            share, had = n / len(own), sum(entity in e for _, e, _ in rows)
            if np.log2(share * len(rows) / had) >= bits and share * n / (n + doubt) >= least:
                out[term] = max(out.get(term, 0), share * n / (n + doubt))
    return {t: "removed" if d >= remove else "term" for t, d in out.items()}


def test_terms_equal_plain_counting(spark):
    rng = random.Random(11)
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    rows = []
    for i in range(400):
        owner = rng.randrange(12)
        terms = {w.replace("w", "q") for w in rng.sample(words, 6)}
        entities = set()
        if i % 4 == 0:
            mail = (f"u{owner}", f"d{owner % 5}.org")
            entities = {("value", "@".join(mail)), ("owner", mail[0]), ("domain", mail[1])}
            terms |= {"name" + chr(97 + owner), "firm" + chr(97 + owner % 5)} if rng.random() < 0.8 else set()
        text = " ".join([*sorted(terms), str(i), *(v for k, v in entities if k == "value")])
        rows.append((text, entities, terms))
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "doc_id long, text string")
    want = plain_terms(rows)
    assert len(want) > 5 and len(set(want.values())) == 2
    got = {}
    for r in pii.spans(docs).collect():
        got |= {s.value.lower(): s.kind for s in r.spans if s.kind != "email"}
    assert got == want


def unpacked(rows, ids):
    """Checks every promise of packing; the sizes of the sequences."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        own = np.asarray(ids[r.doc_id], "<u4")
        assert r.doc_tokens == len(own) and r.length > 0
        assert zlib.crc32(own[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        places[r.sequence_id].append((r.offset, r.length))
    for found, ends in ((pieces, {i: len(x) for i, x in ids.items()}), (places, None)):
        for key, own in found.items():
            end = 0
            for start, length in sorted(own):
                assert start == end
                end += length
            assert ends is None or end == ends[key]
    assert set(pieces) == set(ids)
    return {s: sum(n for _, n in own) for s, own in places.items()}


def hf_ids(rows):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: [*model.encode(t or "", add_special_tokens=False).ids, 0] for i, t in rows}


def test_packing_the_given_table(spark, small):
    docs = small("documents")
    sizes = unpacked(queries.op4_pack(spark, SF).collect(), hf_ids(pairs(docs)))
    assert sorted(sizes)[-1] == len(sizes) - 1
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes.values())


ODD_PACKS = [
    (1, None, "a"),
    (2, "", None),
    (3, "a <|endoftext|> b<|endoftext|>", "b"),
    (4, "x \n \n y   z  \t w     q \x1c \x1d v", None),
    (5, "word " * 4000, "a"),
    (6, "don't  stop 'til 漢字\u3000 ok", "c"),
]


@pytest.mark.parametrize("targets", [None, {"a": 0.5, "b": 0.25, "c": 0.25}, {"b": 1.0}])
def test_packing_odd_rows_with_targets(spark, targets):
    docs = spark.createDataFrame(ODD_PACKS, "doc_id long, text string, source string")
    ids = hf_ids([(i, t) for i, t, _ in ODD_PACKS])
    unpacked(pack.packed(docs, RANKS, targets).collect(), ids)
    unpacked(pack.packed(docs, RANKS, targets, length=16, per_window=2).collect(), ids)
    assert pack.packed(docs.limit(0), RANKS, targets).count() == 0


@pytest.mark.parametrize("targets", [None, {"s7": 0.5, "s5999": 0.5, "absent": 1.0}])
def test_packing_of_thousands_of_sources(spark, targets):
    rows = [(i, "one two three " * (1 + i % 3), f"s{i % 6000}" if i % 4 else "s7", "x", 1, 2) for i in range(7000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, queue string, part int, n int").repartition(3)
    out = pack.packed(docs, RANKS, targets, length=16, per_window=4).collect()
    ids = hf_ids([(i, t) for i, t, *_ in rows])
    unpacked(out, ids)
    windows = defaultdict(lambda: defaultdict(int))
    named = {i for i, _, s, *_ in rows if s in ("s7", "s5999")}
    for r in out:
        windows[r.window]["all"] += r.length
        windows[r.window]["named"] += r.length * (r.doc_id in named)
    sizes = [w["all"] for _, w in sorted(windows.items())]
    assert all(abs(n - 64) <= 4 for n in sizes[:-1])
    if targets:  # named sources first, then the others
        shares = [w["named"] / w["all"] for _, w in sorted(windows.items())]
        last = sum(len(ids[i]) for i in named) // 64
        assert all(x == 1 for x in shares[: last - 1]) and all(x == 0 for x in shares[last + 1 :])


@pytest.mark.parametrize(("totals", "shares"), [((1000, 100_000, 100_000), (0.5, 0.25, 0.25)), ((7, 5, 90_001), (1, 2, 0)), ((9, 9, 9), (0, 0, 0)), ((1, 10**13, 3), None)])
def test_windows_stay_full_where_queues_run_out(totals, shares):
    plan = pack.Plan.make(list(totals), shares and list(shares), 4096)
    some = min(plan.windows, 200)
    edges = [k for k in (*range(some), plan.windows // 2, plan.windows - 1) if k < plan.windows]
    every = np.arange(len(totals))
    for k in edges:
        begin, end = (plan.after(np.full(len(totals), x), every) for x in (k, k + 1))
        assert (begin <= end).all()
        assert k == plan.windows - 1 or abs(int((end - begin).sum()) - 4096) <= len(totals) + 1
    assert plan.after(np.full(len(totals), plan.windows), every).tolist() == list(totals)
    if shares and sum(shares):  # a queue that lasts keeps its share
        k = 1 if totals[0] >= 4096 else 0
        got = plan.after(np.full(3, k), every)
        assert all(abs(g - min(t, 4096 * k * s / sum(shares))) <= 1 for g, t, s in zip(got, totals, shares))


def test_windows_hold_the_target_shares(spark):
    rows = [(i, "a b c d e f g h " * 20, "ab"[i % 2]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = pack.packed(docs, RANKS, {"a": 0.75, "b": 0.25}, length=64, per_window=4)
    shares = defaultdict(lambda: [0, 0])
    for r in out.collect():
        shares[r.window][r.doc_id % 2] += r.length
    full = [v for k, v in sorted(shares.items())][:20]
    assert all(abs(a - 192) <= 1 and abs(b - 64) <= 1 for a, b in full)


def test_chunks_give_the_ids_of_whole_texts():
    """Random strings of every kind of character: cached chunks, ranks and the library agree."""
    rng = random.Random(6)
    model = pack.Tokens(RANKS)
    alphabet = " \n\t\r\u00a0\u3000\x1c aabzé漢1２!'’s.-<|>\u200d😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    for (_, ids), text in zip(sorted(hf_ids(enumerate(texts)).items()), texts, strict=True):
        assert np.frombuffer(model.encode(text), np.uint16).tolist() == ids[:-1]


def test_a_text_is_encoded_by_one_call(monkeypatch):
    """Not word by word, which costs more time than it saves."""
    calls, encode = [], pack.Tokens._encode
    monkeypatch.setattr(pack.Tokens, "_encode", lambda self, text: calls.append(text) or encode(self, text))
    text = "the same and other words " * 50
    ids = np.frombuffer(pack.Tokens(RANKS).encode(text), np.uint16).tolist()
    assert calls == [text] and [*ids, 0] == hf_ids([(0, text)])[0]


def test_overlaps_both_ways(spark, small, odd):
    items = [(1, "one two three"), (2, "One, two; THREE four five six seven eight nine ten eleven twelve"), (3, None), (4, ""), (5, "ab"), (6, "one two three")]
    items = spark.createDataFrame(items, "item_id long, text string")
    texts = ["zero one two three four", "five six seven eight nine ten eleven twelve thirteen", "three four five six seven eight nine ten eleven twelve!", "AB ab", None, ""]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs, bench in ((made, items), (small("documents"), small("benchmark")), (odd.filter("doc_id is not null"), items)):
        expected = brute.overlaps(pairs(docs), [(r.item_id, r.text) for r in bench.collect()])
        for words in (decontaminate.BROADCAST_WORDS, 0):
            got = decontaminate.overlaps(docs, bench, broadcast_words=words).collect()
            assert len(got) == docs.count()
            assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got} == expected
            assert all(sum(b - a for a, b in r.spans) == r.n_hit for r in got)
    assert decontaminate.overlaps(odd, items.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.overlaps(odd.limit(0), items).count() == 0


def test_language_of_held_out_documents(spark, small, odd):
    truth = {r.doc_id: r.lang for r in small("documents").collect()}
    got = queries.op8_language(spark, SF).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert len(got) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    known = language.learn(small("documents"))
    found = {r.doc_id: r for r in language.predict(odd, known).collect() if r.doc_id is not None}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (0, 1, 2)) and found[3].lang_pred in known.languages
    nothing = language.learn(odd.limit(0))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}
    kept = language.accepted(odd, known, 0.0)
    assert kept.columns == odd.columns and kept.filter("text is null or trim(text) = ''").isEmpty()


def test_more_languages_than_bits_in_a_byte(spark):
    rng = random.Random(8)
    rows = []
    for lang in range(70):
        syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(12)]
        rows += [(len(rows) + i, " ".join(rng.choice(syllables) for _ in range(30)), f"l{lang:02}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identified(docs).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)


def test_token_counts_equal_the_library(spark, small, odd):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["a  b \n c ", " a", "  ", "<s>hi</s> <unk>", "x" * 500, "▁ a ▁▁b", "a\u00a0b  c", "\t a"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for docs in (made, small("documents"), odd.filter("doc_id is not null")):
        got = token_count.token_counts(docs, PIECES).collect()
        assert len(got) == docs.count()
        expected = {i: (len((t or "").encode()), len(model.encode(t or ""))) for i, t in pairs(docs)}
        assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == expected
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_count.token_counts(odd.limit(0), PIECES).count() == 0


def test_token_counts_of_random_texts():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_count.Lengths(PIECES, {})
    alphabet = ["a", "b", "the", *[" "] * 4, "  ", *"\t\n\r\0\x01\xa0\xad\u2003\u2028\u200b\ufeff\u3000\u2581\u0301", "é", "漢", "😀", "<s>"]
    rng = random.Random(9)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(9))) for _ in range(5000)]
    texts += [t + end for t in ("", "a", "a b", "\n", "a\t") for end in (" ", "  ", "   ", " \n ")]
    for text in texts:
        assert counter.count(text) == len(model.encode(text)), text


def test_site_quality_on_held_out_labels(spark, small, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = labels.filter("doc_id % 3 != 0")
    got = {r.doc_id: r for r in site_quality.judged(docs, seen, docs.source, docs.lang).collect()}
    assert len(got) == docs.count()
    rest = labels.filter("doc_id % 3 = 0").collect()
    assert sum(got[r.doc_id].kept == (r.quality == 1) for r in rest) >= 0.9 * len(rest)
    assert site_quality.judged(odd, seen, odd.source, odd.lang).count() == odd.count()
    assert site_quality.judged(odd, seen.limit(0), odd.source, odd.lang).count() == odd.count()
    assert site_quality.judged(odd.limit(0), seen, odd.source, odd.lang).count() == 0


def test_sparse_sites_shrink_towards_their_parents(spark):
    rows = [(i, "good" if i < 100 else "bad", "p", 3.0 if i < 100 else -3.0) for i in range(200)] + [(200, "good", "new", 0.0), (201, "other", "p", 0.0)]
    got = {r.doc_id: r for r in site_quality.combined(spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double")).collect()}
    assert got[200].quality > 0.8 and got[0].path_quality > 0.9 > 0.1 > got[150].path_quality
    assert 0.3 < got[201].quality < 0.7
