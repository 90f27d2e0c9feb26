import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylab.llm import (
    chat, decontamination, language, licenses, linededup, neardup, packing, quality, registered,
    sharding, tokens, urls,
)
from tests.llm.helpers import LOWER, components, letters, shingles, table, visible

WORDS = [a + b for a in "ba ce di fo gu ha".split() for b in "la me ni po ru st".split()]


@pytest.fixture(scope="module", autouse=True)
def sent(spark):
    registered.send_package(spark)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_docs(rng):
    """Null, empty, blank, short, very long and repeated texts; ties and null keys."""
    texts = [None, "", " \n\t", "One", "one two", "É! ß 中文 x y", "a" * 5000, prose(rng, 30000)]
    texts += [prose(rng, rng.randint(1, 80)) for _ in range(30)]
    texts += [texts[-1]] * 40
    rows = [(i, t, "en", "src0", 7) for i, t in enumerate(texts)]
    return rows + [rows[10]] * 5 + [(None, texts[12], None, None, None)]


DOCS = "doc_id long, text string, lang string, source string, Shard int"


# Sharding

def test_shards_are_contiguous_gapless_and_near_equal(spark, tmp_path):
    rows = odd_docs(random.Random(1))
    docs = table(spark, tmp_path, rows, DOCS)
    sized = docs.withColumn("size", sharding.text_size(F.col("text")))
    found = sharding.balanced_shards(sized, "doc_id", 5).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r[0], r[1]) for r in rows)
    size = lambda t: len((t or "").encode()) + 8
    share = sum(size(r.text) for r in found) / 5
    by = defaultdict(list)
    for r in found:
        assert r["size"] == size(r.text)
        by[r.shard].append(r)
    last = -2
    for k in sorted(by):
        own = sorted(by[k], key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        for r in own:
            key = -1 if r.doc_id is None else r.doc_id
            assert key >= last
            last = key
        assert abs(sum(r["size"] for r in own) - share) <= max(r["size"] for r in found)


def test_shards_of_one_hot_key_and_of_nothing(spark, tmp_path):
    hot = table(spark, tmp_path, [(7, "x" * 10)] * 900, "doc_id long, text string")
    sized = hot.withColumn("size", sharding.text_size(F.col("text")))
    counts = Counter(r.shard for r in sharding.balanced_shards(sized, "doc_id", 9).collect())
    assert sorted(counts) == list(range(9)) and max(counts.values()) - min(counts.values()) <= 2
    assert sharding.balanced_shards(sized.limit(0), "doc_id", 3).count() == 0


def test_op1_checksums(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in sharding.op1_sharding(spark, sf_dir).collect():
        assert r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())


# Decontamination

def brute_overlaps(text, items, width=10):
    words, hit, names = letters(text), set(), set()
    for item, body in items:
        own = letters(body)
        k = min(width, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1) if windows else ():
            if tuple(words[i : i + k]) in windows:
                hit |= set(range(i, i + k))
                if item is not None:
                    names.add(str(item))
    return len(words), len(hit), sorted(names)


def test_overlaps_equal_brute_force_in_any_number_of_blocks(spark, tmp_path):
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randint(1, 30))) for i in range(15)]
    items += [(20, None), (21, "!!"), (22, items[0][1]), (None, prose(rng, 12))]
    docs = odd_docs(rng)[:40]
    for i in range(100, 140):
        body = rng.choice(items)[1] or ""
        cut = body.upper().replace(" ", ", ") if i % 2 else body
        docs.append((i, prose(rng, 9) + ". " + cut + " " + prose(rng, 9), "en", "s", 1))
    left = table(spark, tmp_path, docs, DOCS)
    right = table(spark, tmp_path, items, "item_id long, text string")
    for blocks in (500_000, 40):
        found = decontamination.find_overlaps(left, right, block_windows=blocks).collect()
        assert len(found) == len(docs)
        for r in found:
            n, hit, names = brute_overlaps(r.text, items)
            spans = [(s.first, s.last) for s in r.hit_spans]
            assert (r.n_words, sum(b - a + 1 for a, b in spans), r.hit_items) == (n, hit, names)
            assert all(b + 1 < c for (_, b), (c, _) in zip(spans, spans[1:]))
    kept = decontamination.drop_contaminated(left.withColumn("n_words", F.lit("own")), right, least_words=1)
    assert kept.columns == [*left.columns, "n_words"]
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if not r.hit_spans}


def test_short_items_drop_no_documents(spark, tmp_path):
    """Common words as items leave clean documents alone; ten words of an item do not."""
    rng = random.Random(8)
    long, nine = prose(rng, 14), prose(rng, 9)
    docs = [(i, prose(rng, 30)) for i in range(30)]
    docs += [(40, f"x {' '.join(long.split()[2:12])} y"), (41, f"x {nine} y"), (42, nine), (43, None), (44, "")]
    left = table(spark, tmp_path, docs, "doc_id long, text string")
    items = table(
        spark, tmp_path, [(1, WORDS[0]), (2, " ".join(WORDS[1:3])), (3, nine), (4, long), (5, None)],
        "item_id long, text string",
    )
    gone = lambda **o: {d for d, _ in docs} - {
        r.doc_id for r in decontamination.drop_contaminated(left, items, **o).collect()
    }
    assert gone() == {40} and gone(least_words=9) == {40, 41, 42} and len(gone(least_words=1)) > 10
    with pytest.raises(ValueError):
        decontamination.drop_contaminated(left, items, least_words=11)


def test_overlaps_with_nothing(spark, tmp_path):
    docs = table(spark, tmp_path, odd_docs(random.Random(3)), DOCS)
    items = table(spark, tmp_path, [(1, "a b c")], "item_id long, text string")
    assert decontamination.find_overlaps(docs, items.limit(0)).where("size(hit_spans) > 0").count() == 0
    assert decontamination.find_overlaps(docs.limit(0), items).count() == 0


# Language

def test_language_accuracy_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    hidden = F.when(F.col("doc_id") % 2 == 0, F.col("lang"))
    found = language.identify(docs.withColumn("label", hidden), "text", "label").select("doc.*", "language", "kept")
    odd = [r for r in found.where("doc_id % 2 = 1").collect() if len(letters(r.text)) > 20]
    assert sum(r.language == r.lang for r in odd) >= 0.99 * len(odd)
    assert sum(r.kept for r in odd) >= 0.99 * len(odd)


def test_language_evidence_and_odd_rows(spark, tmp_path, sf_dir):
    rows = [(1, "xq", None, "a.de"), (2, "xq", "fr", "a.fr"), (3, None, "en", None), (4, "", None, None)]
    rows += [(100 + i, "der und die zu den das", "de", "a.de") for i in range(60)]
    rows += [(200 + i, "le la et les des une", "fr", "b.fr") for i in range(60)] + [rows[0]] * 3
    docs = table(spark, tmp_path, rows, "doc_id long, text string, lang string, source string")
    host = F.col("source")
    got = language.identify(
        docs.withColumn("language", F.lit(1)), declared=F.col("lang"), host=host,
        suffix=language.address_suffix(host),
    ).select("doc.doc_id", "doc.source", "language", "confidence", "kept")
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert by[1].language == "de" and by[2].language == "fr"
    assert not by[3].kept and not by[4].kept and by[100].kept and by[200].language == "fr"
    assert all(0 <= r.confidence <= 1 + 1e-9 for r in by.values())
    assert language.identify_documents(docs.limit(0)).count() == 0
    html = spark.createDataFrame([("<!x><HTML class=a lang='de-AT'>",), ("<p>",), (None,)], "h string")
    assert [r[0] for r in html.select(language.markup_language(F.col("h"))).collect()] == ["de", None, None]
    assert language.keep_identified(docs).columns == docs.columns


def brute_languages(rows, names=language.LANGUAGES):
    """Posteriors of (text, lang, host) rows from the definitions, one row at a time."""
    def grams(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return language._bins(data, np.array([0, len(data)]))[: max(0, len(data) - 2)]

    counts = np.zeros((len(names), language.BINS))
    for text, lang, _ in rows:
        if lang in names:
            np.add.at(counts[names.index(lang)], grams(text), 1)

    def likelihoods(text, lang):
        found = []
        for k, name in enumerate(names):
            own = counts[k].copy()
            if name == lang:
                np.add.at(own, grams(text), -1)
            found.append(np.log((own + 0.5) / (own + 0.5).sum())[grams(text)].sum())
        return np.array([*found, len(grams(text)) * math.log(1 / language.BINS)])

    classes = [*names, "und"]
    said = lambda lang: "none" if lang is None else lang if lang in names else "other"
    suffix = lambda host: host.rsplit(".", 1)[1] if host and "." in host else None
    scores = [likelihoods(t, lang) for t, lang, _ in rows]
    best = [int(np.argmax(x)) if len(grams(r[0])) else None for x, r in zip(scores, rows)]
    share = lambda pick: np.array([sum(b == k and pick(r) for b, r in zip(best, rows)) for k in range(len(classes))])
    smooth = lambda n, above, pull: (n + pull * above) / (n.sum() + pull)
    overall = smooth(share(lambda r: True), np.full(len(classes), 1 / len(classes)), language.EVEN_PULL)
    found = []
    for i, (text, lang, host) in enumerate(rows):
        above = smooth(share(lambda r: suffix(r[2]) == suffix(host)), overall, language.SUFFIX_PULL)
        here = share(lambda r: (r[2] or "") == (host or "")).astype(float)
        if best[i] is not None:
            here[best[i]] -= 1
        prior = smooth(here, above, language.HOST_PULL)
        voice = [
            (sum(b == k and said(r[1]) == said(lang) for b, r in zip(best, rows)) + 1)
            / (sum(b == k for b in best) + len(names) + 2) for k in range(len(classes))
        ]
        points = scores[i] * language.TEXT_WEIGHT + np.log(voice) + np.log(prior)
        chance = np.exp(points - points.max())
        found.append((classes[int(np.argmax(points))], float(chance.max() / chance.sum())))
    return found


def evidence_rows():
    """Rows of several languages, and short texts that one kind of evidence alone can decide."""
    says = {"de": "der und die zu den das ist nicht", "fr": "le la et les des une est pas",
            "en": "the of and to in that is was", "es": "el los las que con por una del"}
    rng = random.Random(3)
    prose_of = lambda c, n: " ".join(rng.choice(says[c].split()) for _ in range(n))
    rows = []
    for i in range(160):
        lang = "de fr en es".split()[i % 4]
        rows.append((prose_of(lang, 12), lang if i % 3 else None, f"h{i % 7}.{'example' if i % 2 else 'net'}"))
    rows += [(prose_of("de", 12), "de", f"s{i}.de") for i in range(60)]  # a suffix of one language
    rows += [(prose_of("es", 12), "es", "solo.example") for _ in range(60)]  # a host of one language
    rows += [(prose_of("fr", 9), "fr", None) for _ in range(20)] + [(prose_of("en", 9), None, "") for _ in range(20)]
    short = [("qzx", None, "new.de"), ("qzx", None, "solo.example"), ("qzx", "fr", "h1.example"), ("qzx", "xx", None)]
    return rows, short, [(None, None, None), ("", "de", "s1.de"), ("ab", None, "h1.net"), ("qzx", None, None)]


@pytest.mark.parametrize("hosts", [200_000, 0])
def test_every_kind_of_evidence_counts(spark, tmp_path, monkeypatch, hosts):
    monkeypatch.setattr(language, "HOSTS", hosts)
    rows, short, odd = evidence_rows()
    every = rows + short + odd + rows[:3]
    given = [(i, t, lang, h, "x") for i, (t, lang, h) in enumerate(every)]
    docs = table(spark, tmp_path, given, "id long, TEXT string, Lang string, host string, language string")
    host = F.col("host")
    got = language.identify(docs, "text", "lang", F.col("lang"), host, language.address_suffix(host))
    got = {r.id: r for r in got.select("doc.id", "language", "confidence", "kept").collect()}
    assert len(got) == len(every)
    for i, (name, confidence) in enumerate(brute_languages(every)):
        assert got[i].language == name and got[i].confidence == pytest.approx(confidence, rel=1e-6), every[i]
    at = len(rows)
    # Suffix alone, host alone and declaration alone tell short texts apart.
    assert [got[at + k].language for k in range(3)] == ["de", "es", "fr"]
    assert not got[at + 4].kept and not got[at + 5].kept


def test_pages_bring_their_evidence(spark, tmp_path):
    rows, _, _ = evidence_rows()
    docs = table(spark, tmp_path, [(i, t, lang, h) for i, (t, lang, h) in enumerate(rows[:80])] + [(900, "qzx", None, "new.de")],
                 "doc_id long, text string, lang string, source string")
    html = "<html lang='{}-AT'><script>the of and</script><p>{}</p></html>"
    pages = table(
        spark, tmp_path, [(i, f"http://u@{h}:80/x", html.format(lang, t)) for i, (t, lang, h) in enumerate(rows[160:220])],
        "page_id long, url string, html string",
    )
    every = language.identify_corpus(language.corpus_rows(docs, pages)).select("doc.*", "language").collect()
    assert {r.language for r in every if r.page_id is not None} == {"de"}
    assert {r.host for r in every if r.page_id == 0} == {"s0.de"}
    alone = {r.doc.doc_id: r.language for r in language.identify_documents(docs).collect()}
    both = {r.doc.doc_id: r.language for r in language.identify_documents(docs, pages).collect()}
    # The suffix of an unknown host is known from the pages alone.
    assert set(alone) == set(both) and both[900] == "de" != alone[900]
    wide = docs.withColumns({"_page": F.lit("own"), "host": F.lit(1), "doc": F.lit(2), "a.b": F.lit(3)})
    kept = language.keep_identified(wide, pages)
    assert kept.columns == wide.columns and {r["_page"] for r in kept.collect()} == {"own"}
    assert language.identify_documents(docs.limit(0), pages).count() == 0
    assert language.keep_identified(docs, pages.limit(0)).count() > 60


# Tokens and packing

def test_tokens_equal_those_of_the_library():
    from tokenizers import Tokenizer

    rng = random.Random(4)
    parts = ["'", "s", "t", "re", "ll", "d", " ", "  ", "\n", "a", "1", "!", ".", "é", " ", "\r", "中", "<|endoftext|>"]
    texts = ["", "it's we're 'x''s !'s  's", "a  b\n\n c \n", "x’s", "\0", "I'VE 've"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    library = Tokenizer.from_file(packing.public_vocabulary())
    encoder = tokens.load(packing.public_vocabulary())
    ids, at = encoder.encode(texts)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_differencing_is_near_equal_and_never_over():
    rng = random.Random(5)
    lengths = [rng.randint(1, 512) for _ in range(600)]
    members = packing.fill(lengths, 2048)
    assert sorted(i for m in members for i in m) == list(range(600))
    assert all(sum(lengths[i] for i in m) <= 2048 for m in members)
    assert len(members) <= -(-sum(lengths) // 2048) * 1.03 + 1
    sums, _ = packing.difference([8, 7, 6, 5, 4], 2)
    assert sorted(sums.tolist()) == [14, 16]
    assert packing.fill([2047, 2047, 2047], 2048) and packing.fill([], 2048) == []


def test_packing_holds_every_id_once(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = odd_docs(random.Random(6))
    docs = table(spark, tmp_path, rows, DOCS)
    pieces = packing.cut_documents(docs.withColumn("start", F.lit("own")))
    packed = packing.pack(pieces).collect()
    library = Tokenizer.from_file(packing.public_vocabulary())
    wanted, found = Counter(), Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [1]
        wanted[(r[0], len(ids), b"".join(i.to_bytes(4, "little") for i in ids))] += 1
    sequences = defaultdict(list)
    for p in packed:
        assert len(p.ids) == 4 * p.length and 1 <= p.length <= 2048
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        place = 0
        for offset, length in sorted(own):
            assert offset == place
            place += length
        assert place <= 2048
    # Equal documents give equal pieces: put them together as often as their first piece occurs.
    by = defaultdict(list)
    for p in packed:
        by[(p.doc_id, p.doc_tokens, p.start)].append(bytes(p.ids))
    for (doc, n, start), bodies in by.items():
        if start == 0:
            text, at = [bodies[0]], len(bodies[0]) // 4
            while at < n:
                text.append(by[(doc, n, at)][0])
                at += len(text[-1]) // 4
            found[(doc, n, b"".join(text))] += len(bodies)
    single = {k: v for k, v in wanted.items()}
    assert sum(found.values()) == sum(single.values()) and set(found) <= set(single)
    assert packing.packed_documents(docs.limit(0)).count() == 0
    whole = packing.packed_documents(docs).collect()
    assert all(zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length for p in whole)
    assert "ids" not in packing.packed_documents(docs, with_ids=False).columns
    with pytest.raises(Exception, match="a piece must have"):
        packing.pack(spark.range(1).withColumn("length", F.lit(4000))).count()


# Line chunks

def test_line_dedup_removes_shared_passages_wherever_they_stand(spark, tmp_path):
    rng = random.Random(7)
    shared = [prose(rng, 12) for _ in range(12)]
    rows = [(0, "\n".join(shared), "x")]
    for i in range(1, 20):
        own = [prose(rng, 10) for _ in range(rng.randint(1, 9))]
        at = rng.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + shared + own[at:]), "x"))
    rows += [(30, None, "x"), (31, "", "x"), (32, "\n\n\n", "x"), (33, "one line", "x"), (34, "one line", "x")]
    rows += [(40, "a\n" * 3000, "x")] + [(50, rows[1][1], "x")]
    docs = table(spark, tmp_path, rows, "doc_id long, text string, chunks string")
    found = {r.doc_id: r.text for r in linededup.without_repeats(docs).collect()}
    texts = {r[0]: r[1] for r in rows}
    assert 50 not in found or 1 not in found or found[50] != texts[50]
    lines = Counter(line for i, t in found.items() if i < 20 for line in t.split("\n"))
    # Away from its ends the passage stands once.
    assert sum(lines[s] == 1 for s in shared) >= 5 and all(lines[s] >= 1 for s in shared)
    for i, text in found.items():
        whole = (texts[i] or "").split("\n")
        left = iter(whole)
        assert text is None or all(line in left for line in text.split("\n"))
        assert all(line in (text or "").split("\n") for line in whole if i < 20 and line not in shared)
    assert found[30] is None and found[31] == "" and found[33] == found[34] == "one line"
    assert linededup.without_repeats(docs).columns == docs.columns
    assert linededup.without_repeats(docs.limit(0)).count() == 0
    stored = linededup.chunked(docs)
    for r in stored.select("doc.doc_id", F.expr("array_join(transform(chunks, c -> c.text), '\n')")).collect():
        assert r[1] == texts[r[0]]


def brute_passages(texts):
    """Texts by row without pairs of visible lines that stand in an earlier place of their own."""
    first, left = {}, []
    for row, text in enumerate(texts):
        lines = text.split("\n")
        seen = [i for i, line in enumerate(lines) if visible(line)]
        lost = set()
        for start, upto in zip(seen, seen[1:]):
            place = first.setdefault(tuple(lines[start : upto + 1]), (row, upto))
            if place < (row, start):
                lost |= set(range(start, upto + 1))
        for i in seen:
            if len(visible(lines[i])) >= 50 and first.setdefault(lines[i], (row, i)) != (row, i):
                lost.add(i)
        left.append("\n".join(x for i, x in enumerate(lines) if i not in lost))
    return left


def test_line_dedup_finds_short_passages_inside_texts(spark, tmp_path):
    rng = random.Random(31)
    line = lambda: prose(rng, rng.randint(3, 9)) + f" {rng.random()}"
    passages = [[line() for _ in range(n)] for n in (2, 3, 4, 5, 6) for _ in range(12)]
    texts = []
    for passage in passages * 3:
        own = [[line() for _ in range(rng.randint(1, 7))] for _ in range(2)]
        texts.append("\n".join(own[0] + passage + own[1]))
    single = line()
    # Single lines between blank ones stay, a gap inside a passage does not hide it.
    texts += [f"{line()}\n\n{single}\n\n{line()}" for _ in range(3)]
    texts += [f"{line()}\ngap one\n\ngap two\n{line()}" for _ in range(2)]
    texts += ["\n".join([line(), *["same same"] * n, line()]) for n in (3, 4, 5)]
    # Single lines are passages from fifty words on.
    long, almost = (" ".join(rng.choice(WORDS) for _ in range(n)) for n in (50, 49))
    texts += [f"{line()}\n{long}\n{line()}\n{almost}\n\n{line()}" for _ in range(3)]
    path = str(tmp_path / "texts")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    found = {r.doc_id: r.text for r in linededup.without_repeats(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_passages(texts)
    lines = Counter(x for t in found.values() for x in t.split("\n"))
    assert all(lines[x] == 1 for passage in passages for x in passage) and lines[single] == 3
    assert lines[long] == 1 and lines[almost] == 3


def test_the_filter_of_repeated_chunks_works_before_rows_travel(spark, tmp_path):
    rng = random.Random(5)
    hashes = {rng.randint(-(1 << 63), (1 << 63) - 1) for _ in range(3000)}
    hashes |= {0, -1, 63, 64, -(1 << 63), (1 << 63) - 1}
    each = table(spark, tmp_path, [(h, "t") for h in hashes], "hash long, text string")
    often = each.where("hash % 7 = 0").select("hash")
    candidates = lambda: linededup._in_slots(each, often).join(often, "hash", "left_semi")
    assert {r["hash"] for r in candidates().collect()} == {r["hash"] for r in often.collect()}
    assert linededup._in_slots(each, often).count() < 0.3 * len(hashes)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = candidates()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.index("SortMergeJoin") < text.index("Exchange") < text.index("BroadcastHashJoin [(pmod(hash")


# Quality

def brute_statistics(text):
    words = [w for w in visible_case(text)]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in (text or "").split("\n") if visible(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def visible_case(text):
    from tests.llm.helpers import VISIBLE

    return VISIBLE.findall(text or "")


def test_statistics_equal_brute_force(spark, tmp_path, sf_dir):
    rng = random.Random(8)
    rows = odd_docs(rng)
    loop = [rng.choice(WORDS[:2]) for _ in range(60)]
    rows += [(900, " ".join(["a"] * 30), "", "", 0), (901, " ".join(loop), "", "", 0), (902, "x y\nx y\n\n \nx y#|", "", "", 0)]
    passage = prose(rng, 9)
    rows += [(903, passage + " z " + passage + " " + prose(rng, 30), "", "", 0), (904, "é ß a\u000bb c", "", "", 0)]
    docs = table(spark, tmp_path, rows, DOCS)
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for source in (docs, real):
        for r in quality.text_statistics(source).collect():
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert got == brute_statistics(r.text), r.doc_id


def test_learned_list_finds_a_planted_rule(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for i in range(900):
        bad = i % 5 == 0
        rows.append((i, 100, 500, 90 if bad else rng.randint(0, 5), 0, 0, rng.randint(0, 9), 0, 5, 0 if bad else 1))
    names = "doc_id long, " + ", ".join(f"{c} long" for c in quality._STATISTICS) + ", quality int"
    labelled = table(spark, tmp_path, rows, names)
    rules = quality.learn(labelled)
    assert rules and rules[0].terms[0].measure == "symbol_share" and rules[0].terms[0].above
    wrong = labelled.where(quality.verdict(rules) != (F.col("quality") == 1)).count()
    assert wrong <= 5
    assert quality.learn(labelled.where("quality = 1")) == [] and quality.learn(labelled.limit(0)) == []


def test_a_rare_kind_is_learned_and_noise_is_not(spark, tmp_path):
    """A few bad rows in the tail of one measure make a rule; labels drawn at random make none."""
    rng = random.Random(10)

    def row(i, symbols, label):
        return (i, 100, 500, symbols, 0, 0, rng.randint(0, 9), rng.randint(0, 9), 5, label)

    rows = [row(i, rng.randint(0, 20), 1 if rng.random() > 0.02 else 0) for i in range(3000)]
    rows += [row(5000 + i, rng.randint(60, 90), 0) for i in range(14)]
    names = "doc_id long, " + ", ".join(f"{c} long" for c in quality._STATISTICS) + ", quality int"
    labelled = table(spark, tmp_path, rows, names)
    rules = quality.learn(labelled)
    assert len(rules) == 1 and rules[0].terms[0].measure == "symbol_share" and rules[0].terms[0].above
    covered = labelled.where(~quality.verdict(rules))
    assert covered.where("doc_id >= 5000").count() == 14 and covered.count() <= 16
    strict = quality.Learning(least_saving=1e6)
    assert quality.learn(labelled, settings=strict) == []
    noise = labelled.withColumn("quality", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))).cast("int"))
    assert quality.learn(noise) == []


def test_op6_keeps_good_documents(spark, sf_dir):
    path = sf_dir.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    found = quality.op6_quality_rules(spark, path).collect()
    good = [r for r in found if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert all(not r.kept for r in found if r.base_failed)
    bad = [r for r in found if labels.get(r.doc_id) == 0]
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad)


# Addresses

def brute_url(url, rules):
    host, path = urls.split_url(url)
    fits = [
        r for r in rules
        if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])
    ]
    return max(fits, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), default=None)


def test_urls_equal_brute_force_in_any_number_of_blocks(spark, tmp_path):
    rng = random.Random(10)
    hosts = ["net", "a.net", "b.a.net", "org", "x.org", "net.org", "A.Net", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/english", "/en/x/y?q=/fr/", "#a", "/de//x"]
    rules = [("block", "net", "/"), ("allow", "a.net", "/en/"), ("block", "a.net", "/en/x"), ("allow", "org", "/e"),
             ("block", "org", "/en"), ("allow", "x.org", ""), ("block", "b.a.net", "/"), ("allow", "b.a.net", "/"),
             # The host with more labels is not the longer rule here, and ties go to the longer host.
             ("allow", "net", "/en/x/y"), ("allow", "net", "/de//x"), ("block", "a.net", "/de/")]
    addresses = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "x" * 4000]
    rows = [(i, u, "own") for i, u in enumerate(addresses + addresses[:3])]
    pages = table(spark, tmp_path, rows, "page_id long, url string, verdict string")
    listed = spark.createDataFrame(rules, "action string, host string, path string")
    for given, size in ((rules, 200_000), (rules, 3), (listed, 200_000), (listed, 4)):
        judged = urls.judge_urls(pages, given, "URL", block_rules=size).collect()
        assert sorted((r.page_id, r.url or "") for r in judged) == sorted((r[0], r[1] or "") for r in rows)
        for r in judged:
            best = brute_url(r.url, rules)
            assert (r.rule, r.verdict) == ((best[1] + best[2], best[0]) if best else (None, "allow")), r
    assert urls.judge_urls(pages, []).where("verdict = 'allow' and rule is null").count() == len(rows)
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        urls.judge_urls(pages, [("maybe", "a", "/")])


def test_many_rules_of_one_host_are_not_searched_one_by_one():
    rules = [("block", "a.net", f"/p{i}/x{i % 1000}") for i in range(200_000)]
    trie = urls.Trie([*rules, *(("allow", "a.net", f"/{i:x}") for i in range(200_000))])
    began = time.process_time()
    for i in range(10_000):
        assert trie.longest("www.a.net", f"/p{i}/x{i % 1000}/more")[2] == f"/p{i}/x{i % 1000}"
        assert trie.longest("a.net", f"/{i:x}zzz")[2] == f"/{i:x}"
    assert (time.process_time() - began) / 20_000 < 0.0001


# Conversations

def test_chat_round_trip_and_order(spark, tmp_path):
    nasty = ["<|im_end|>", "<|", "<||", "<|n", "a<", "|x", "<|im_start|>assistant\nok", "\n", "<|im_end|>\n", "", None]
    rng = random.Random(11)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 6)):
            text = "".join(rng.choice(nasty) or "" for _ in range(3)) if c % 3 else rng.choice(nasty)
            rows.append((c, t, ["user", "assistant"][t % 2] if c % 4 else rng.choice(nasty), text, 1))
    rows += [(100, 0, "system", "s", 1), (100, 1, "user", "u", 1), (100, 2, "assistant", "a", 1)]
    rows += [(101, 0, "user", "u", 1), (101, 0, "user", "u", 1), (102, 0, "assistant", "x", 1), (None, None, None, None, 1)]
    turns = table(spark, tmp_path, rows, "conv_id long, turn long, role string, text string, valid int")
    done = chat.format_conversations(turns).withColumn("turns", chat.read_turns(F.col("formatted")))
    done = {r.conv_id: r for r in done.withColumn("loss", chat.loss_text(F.col("segments"))).collect()}
    by = defaultdict(list)
    for c, t, role, text, _ in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(done) == set(by)
    for c, own in by.items():
        own.sort()
        assert [(x.role, x.text) for x in done[c].turns] == [(r, t) for _, r, t in own]
        assert done[c].loss == "".join(t for _, r, t in own if r == "assistant")
        assert done[c].formatted == "".join(s.text for s in done[c].segments)
    assert done[100].valid and done[100].broken_at is None
    assert not done[101].valid and done[101].broken_at == 1
    assert not done[102].valid and done[102].broken_at == 0
    assert chat.format_conversations(turns.limit(0)).count() == 0


# Near duplicates

def brute_near(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, components(sets, links)


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, tmp_path, k, percent, monkeypatch):
    rng = random.Random(12 + k)
    passage = prose(rng, 60)
    rows = [(i, r[1]) for i, r in enumerate(odd_docs(rng)[:45])]
    for base in range(4):
        words = prose(rng, 120).split()
        for _ in range(60):
            own = list(words)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, prose(rng, 40) + " " + passage + " " + prose(rng, 40)) for i in range(60)]
    rows += [(len(rows) + i, t) for i, t in enumerate(["a b c", "A B\nc", "a b", "a b c d", "x"])]
    sets, wanted = brute_near(rows, k, percent)
    docs = table(spark, tmp_path, rows, "doc_id long, text string")
    for left in (160, 0, 10**9):
        monkeypatch.setattr(neardup, "PAIRS_LEFT", left)
        found = neardup.near_duplicates(docs, k=k, percent=percent).collect()
        assert len(found) == len(rows)
        assert {r.key: r.component for r in found} == wanted
        assert all(r.n_shingles == len(sets[r.key]) for r in found)


@pytest.mark.parametrize("cell,levels", [(512, 4), (40, 4), (40, 0), (70, 1)])
def test_large_regions_are_joined_in_cells(spark, tmp_path, monkeypatch, cell, levels):
    """Mosaics of common passages: hundreds of documents share every rare shingle."""
    rng = random.Random(21)
    passages = [prose(rng, 40) for _ in range(9)]
    rows = [(i, " ".join(rng.sample(passages, 5))) for i in range(260)]
    rows += [(1000 + i, prose(rng, rng.randint(30, 60)) + " " + passages[0]) for i in range(60)]
    rows += [(2000 + i, rows[i][1] + " " + rng.choice(WORDS)) for i in range(30)] + [(3000, rows[5][1])] * 40
    _, wanted = brute_near(rows, 5, 80)
    docs = table(spark, tmp_path, rows, "doc_id long, text string")
    monkeypatch.setattr(neardup, "PAIRS_LEFT", 10**9)
    monkeypatch.setattr(neardup, "CELL", cell)
    monkeypatch.setattr(neardup, "CELL_LEVELS", levels)
    monkeypatch.setattr(neardup, "FEW", 6)
    seen = []
    exact = neardup._Join.exact
    monkeypatch.setattr(neardup._Join, "exact", lambda self, near: seen.append(near.count()) or exact(self, near))
    found = neardup.near_duplicates(docs).collect()
    assert {r.key: r.component for r in found} == wanted and len(found) == len(rows)
    # Two of three sets of a pair share passages; coordinates leave few to be measured.
    assert sum(seen) < 0.1 * len(wanted) ** 2 / 2


def test_near_duplicates_keep_one_of_each_group(spark, tmp_path):
    rows = odd_docs(random.Random(13))
    docs = table(spark, tmp_path, rows, DOCS)
    wide = docs.withColumn("row", F.lit("own")).withColumn("key", F.lit(1))
    kept = neardup.drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    kept = kept.collect()
    texts = [r.text for r in kept if shingles(r.text, 5)]
    assert len(texts) == len({tuple(visible(t)) for t in texts})
    assert {tuple(visible(t)) for t in texts} == {tuple(visible(r[1])) for r in rows if visible(r[1])}
    assert sum(not visible(r.text) for r in kept) == sum(not visible(r[1]) for r in rows)
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_go_by_numbers_of_one_scan(spark, tmp_path):
    rng = random.Random(17)
    texts = [prose(rng, 30) + f" {rng.random()}" for _ in range(12)]
    path = str(tmp_path / "files")
    rows = [(i, t) for i, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id").write.parquet(path)
    docs = spark.read.parquet(path)
    # Splits as with one core before the groups are known, as with many after.
    changed = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        one = docs.rdd.getNumPartitions()
        kept = neardup.drop_near_duplicates(docs)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    try:
        again = spark.read.parquet(path)
        assert one == 1 < again.rdd.getNumPartitions()
        assert sorted(map(tuple, kept.collect())) == rows[:12]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# Licence notices

def test_exact_notices_equal_brute_force_and_fuzzy_ones_are_found(spark, tmp_path):
    rng = random.Random(14)
    rows = [(i, r[1]) for i, r in enumerate(odd_docs(rng))]
    rows += [
        (500, "CC BY cc-by, (cc by) cc cc by"), (501, "x General. Public, LICENSE; all rights\nreserved"),
        (502, "overall rights reservedly"), (503, prose(rng, 50) + " all rigths reserved " + prose(rng, 5)),
        (504, "Permision is hereby grantd, free of charge, to any person"), (505, "cc  by"), (506, "ccby"),
        (507, "all rights reserved all rights reserved"),
    ]
    docs = table(spark, tmp_path, rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan_notices(docs.withColumn("notices", F.lit(1)), (*licenses.EXACT, *licenses.FUZZY)).collect()}
    for i, text in rows:
        words = letters(text)
        wanted = sorted(
            (n.label, p) for n in licenses.EXACT for m in [n.phrase.split()]
            for p in range(len(words) - len(m) + 1) if words[p : p + len(m)] == m
        )
        got = sorted((n.label, n.first_word) for n in found[i].notices if n.allowed == 0)
        assert got == wanted and found[i].n_words == len(words), text
    assert [(n.label, n.errors, n.first_word) for n in found[503].notices] == [("reserved", 2, 50)]
    assert ("mit", 2) in [(n.label, n.errors) for n in found[504].notices]
    assert licenses.scan_notices(docs.limit(0)).count() == 0


def test_long_repetitive_texts_take_time_in_proportion():
    """Hundreds of kilobytes of one notice: every copy is found, in seconds."""
    scanner = licenses.Scanner(licenses.FUZZY)
    one = b"permission is hereby granted free of charge to any person "
    for text, label in ((one * 12_000, "mit"), (b"all rights reserved " * 20_000, "reserved")):
        began = time.process_time()
        places = scanner.places(b" " + text)
        assert time.process_time() - began < 30
        found = [(s, e, n) for notice, s, e, n in places if notice.label == label]
        assert len(found) == text.count(b" ") // label_words[label] and {n for _, _, n in found} == {0}
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


label_words = {"mit": 10, "reserved": 3}


def test_best_of_overlapping_matches():
    rng = random.Random(15)
    for _ in range(300):
        matches = set()
        for _ in range(rng.randint(0, 30)):
            s = rng.randint(0, 60)
            matches.add((s, s + rng.randint(1, 12), rng.randint(0, 3)))
        kept = []
        for m in sorted(matches, key=lambda m: (m[2], m[0], m[1])):
            if all(m[1] <= a or b <= m[0] for a, b, _ in kept):
                kept.append(m)
        assert licenses._best(matches) == sorted(kept)


def test_seeds_make_up_the_phrase():
    for n in licenses.FUZZY:
        parts = licenses.seeds(n)
        assert len(parts) == n.errors + 1 and "".join(p for _, p in parts) == n.phrase
        assert n.phrase == n.phrase.translate(LOWER)
