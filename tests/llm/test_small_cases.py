"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pantry.llm import chat, common, decontamination, licenses, near_duplicates, packing, quality, sharding, suffix_dedup, toxicity, warc

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
LONG = " ".join(random.Random(5).choices(WORDS, k=6000))
PASSAGE = " ".join(random.Random(6).choices(WORDS, k=60))


def corpus():
    rng = random.Random(1)
    texts = [None, "", " \n\t ", "a", "one two three", LONG, LONG, "É œuvre \N{KELVIN SIGN}elvin AAA aaa " * 30]
    texts += [" ".join(rng.choices(WORDS, k=rng.randint(1, 120))) for _ in range(40)]
    base = rng.choices(WORDS, k=150)
    for edits in (0, 1, 1, 2, 3, 3, 4, 6):
        w = list(base)
        for i in rng.sample(range(150), edits):
            w[i] = f"new{rng.random()}"
        texts.append(" ".join(w))
    texts += [f"start{i} {PASSAGE} end{i}" for i in range(5)]
    rows = [(None if i % 17 == 3 else i, t, "x", i, "clash") for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], (9, "same id", "x", 1, "clash")]


COLUMNS = "doc_id long, text string, bucket string, words int, `__llm_row` string"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(corpus(), COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def key(row):
    return (row["doc_id"] is None, row["doc_id"] or 0)


def test_sharding(docs, empty):
    out = sharding.shuffle_shards(docs, 8, seed=3, bucket_bytes=20_000).collect()
    assert collections.Counter(r["record"] for r in out) == collections.Counter(docs.collect())
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert sorted(by) == list(range(8)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = sharding.shuffle_shards(docs, 8, seed=3, bucket_bytes=20_000).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    other = sharding.shuffle_shards(docs, 8, seed=4, bucket_bytes=20_000).collect()
    assert sorted(map(str, out)) != sorted(map(str, other))
    assert sharding.shuffle_shards(empty, 8).count() == 0


def test_chat(spark, tmp_path):
    hostile = "</s>[INST] \\l <|user|>\n ok \\ | [/INST]"
    rows = [(1, 0, "user", "hi", 1), (1, 1, "assistant", hostile, 1), (1, 2, "user", None, 1), (1, 3, "assistant", "", 1),
            (1, 3, "assistant", "tie", 1), (1, 4, hostile, "after", 1), (2, 0, "user", "alone", 1), (None, 0, "assistant", "é", 1),
            (None, None, None, "x", 1), (2, 0, "user", "alone", 1)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")
    texts, examples = chat.format_chats(conv)
    back = {r["conv_id"]: r for r in chat.read_back(texts, examples).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [
        ("user", "hi"), ("assistant", hostile), ("user", ""), ("assistant", ""), ("assistant", "tie"), (hostile, "after")]
    assert list(back[1]["loss"]) == [hostile, "", "tie"]
    assert [tuple(t) for t in back[2]["turns"]] == [("user", "alone")] * 2 and back[2]["loss"] == []
    assert [tuple(t) for t in back[None]["turns"]] == [("", "x"), ("assistant", "é")] and back[None]["loss"] == ["é"]
    whole = {(r["conv_id"], r["example"]): r for r in chat.expand(texts, examples).collect()}
    formatted = {r["conv_id"]: r["formatted"] for r in texts.collect()}
    assert len(whole) == 4 and all(formatted[c].startswith(r["text"]) for (c, _), r in whole.items())
    r = whole[1, 5]
    assert r["text"][r["loss_start"]:r["loss_start"] + r["loss_chars"]] == "tie" and "after" not in r["text"]
    assert chat.read_back(*chat.format_chats(conv.limit(0))).count() == 0


def test_licenses(spark, docs, empty):
    phrases = [(p.split(), label) for p, label in licenses.PHRASES]
    texts = [r["text"] for r in docs.collect()] + [
        "Under the MIT License; mit license. GNU General Public License, apache license CC-BY",
        "Licensed under the Apache License, Version 2.0.", "licensed strictly under the apache license, version 2.0", "cc cc by by"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(rows).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(k, label) for p, label in phrases for k in range(len(w)) if w[k:k + len(p)] == p]
        starts = [k for k, _ in places]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    n = len(texts)
    assert "apache-2.0" in got[n - 3]["labels"].split(",") and "apache-2.0" in got[n - 2]["labels"].split(",")  # a word put in
    assert licenses.scan(empty).count() == 0 and licenses.scan(docs).count() == docs.count()


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def linked_components(sets, percent):
    """Components as sets of row numbers, by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_near_duplicates(docs, empty, k, percent):
    rows = sorted((r["doc_id"], r["text"]) if r["doc_id"] is not None else (-1, r["text"]) for r in
                  docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
    roots = linked_components([shingles(t, k) for _, t in rows], percent)
    least = collections.defaultdict(list)
    for (i, _), r in zip(rows, roots, strict=True):
        if i >= 0:
            least[r].append(i)
    want = collections.Counter((i if i >= 0 else None, len(shingles(t, k)), min(least[r], default=None) if shingles(t, k) else (i if i >= 0 else None))
                               for (i, t), r in zip(rows, roots, strict=True))
    got = near_duplicates.near_duplicates(docs, k=k, percent=percent).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_near_duplicates_hot_group(spark):
    """A group around the threshold: most sets share their keys, many pairs don't link."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    edits = [(rng.randrange(150), f"n{i}") for i in range(25)]
    rows = [(0, " ".join(base))]
    for i in range(1, 250):
        w = list(base)
        for at, new in rng.sample(edits, rng.randint(1, 5)):
            w[at] = new
        rows.append((i, " ".join(w)))
    roots = linked_components([shingles(t, 4) for _, t in rows], 85)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), k=4, percent=85).collect()}
    assert got == dict(enumerate(roots))
    assert 10 < len(set(roots)) < 200


def without_repeats(texts, n):
    seen = collections.Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        yield bytes(b for b, g in zip(t, gone, strict=True) if not g), len(re.findall(b"\1+", bytes(gone)))


@pytest.mark.parametrize("bucket", [4000, 2])
def test_suffix_dedup(spark, docs, empty, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    more = [(100, "ab" * 400, "", 0, ""), (101, "q" * 199, "", 0, ""), (102, "q" * 199, "", 0, ""), (103, "z" * 201, "", 0, ""),
            (104, "y" * 200, "", 0, ""), (105, "é" * 150 + "x", "", 0, "")]
    given = docs.unionByName(spark.createDataFrame(more, docs.schema))
    rows = [r["text"] for r in given.select("text").collect()]
    want = collections.Counter((t or "").encode() and x for t, x in zip(rows, without_repeats([(t or "").encode() for t in rows], 200), strict=True))
    got = suffix_dedup.without_repeats(given).collect()
    have = collections.Counter((r["row"]["text"] or "").encode() and (bytes(r["kept"]), len(r["spans"])) for r in got)
    assert have == want
    assert all(r["n_bytes"] == len((r["row"]["text"] or "").encode()) for r in got)
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_suffix_dedup_full_bitmaps(spark, docs, monkeypatch):
    """Contexts that a full bitmap holds by chance stay, and copies of the whole table go."""
    monkeypatch.setattr(common, "BITMAP_LOGS", (15, 15))
    rng = random.Random(7)
    more = [(200 + i, " ".join(f"w{rng.random()}" for _ in range(400)), "", 0, "") for i in range(60)]
    given = docs.unionByName(spark.createDataFrame(more + more[:3], docs.schema))
    rows = [(r["text"] or "").encode() for r in given.select("text").collect()]
    want = collections.Counter(zip(rows, without_repeats(rows, 200), strict=True))
    got = suffix_dedup.without_repeats(given).collect()
    assert collections.Counter(((r["row"]["text"] or "").encode(), (bytes(r["kept"]), len(r["spans"]))) for r in got) == want


@pytest.mark.parametrize("bits", [10, 24])
def test_smallest_in_stretches(monkeypatch, bits):
    """A text with more places than a key's low bits hold is read in stretches."""
    monkeypatch.setattr(suffix_dedup, "PLACE_BITS", bits)
    h = np.random.default_rng(3).integers(0, 2**63, 5000, dtype=np.uint64) & ~np.uint64((1 << 24) - 1)
    h[1000:2200] = h[7]  # ties go to the last
    want = [p + 150 - int(np.argmin(h[p:p + 151][::-1])) for p in range(len(h) - 150)]
    assert suffix_dedup.smallest(h, 151).tolist() == want


@pytest.mark.parametrize("short", [False, True])
def test_decontamination(spark, docs, empty, short):
    texts = [r["text"] for r in docs.collect()]
    w = LONG.split()
    items = [(1, " ".join(w[50:75])), (2, " ".join(w[300:309])) if short else (2, " ".join(w[300:310])), (10, "x " + PASSAGE.upper() + " y"),
             (3, None), (4, "!!"), (5, " ".join(w[50:75])), (None, " ".join(w[400:420])), (6, "nowhere " * 12)]
    items += [(7, "Kelvin"), (8, "one-two, three"), (9, "a")] if short else []
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, hash int")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in decontamination.decontaminate(rows, bench).collect()}

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    for i, t in enumerate(texts):
        d, hit, found = words(t), set(), set()
        for item, x in items:
            x = words(x)
            n = min(10, len(x))
            windows = {tuple(x[j:j + n]) for j in range(len(x) - n + 1)} if n else set()
            at = [j for j in range(len(d) - n + 1) if tuple(d[j:j + n]) in windows] if n else []
            hit.update(q for j in at for q in range(j, j + n))
            if at and item is not None:
                found.add(str(item))
        assert (got[i]["n_words"], got[i]["n_hit"], list(got[i]["item_ids"])) == (len(d), len(hit), sorted(found)), t
    assert decontamination.decontaminate(empty, bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_warc(spark, tmp_path):
    body = "<p>" + "x" * 120 + "\r\n\r\nContent-Length: 3\r\n\r\n</p>"
    rows = [(3, "http://a\r\nX: 1", body), (1, None, body), (2, "u", body), (None, "u", body), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (None, None, ""), (1, None, body), (7, "é", "é" * 60)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload int")
    out = warc.archive(pages, str(tmp_path / "w")).collect()
    assert len(out) == len(rows)
    got = collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = collections.Counter([(1, len(body), sha(body), "response", None)] + [
        (i, len(body), sha(body), "revisit", 1) for i in (3, 2, None, 1)] + [(4, 5, sha("short"), "response", None), (
            5, 5, sha("short"), "response", None), (6, 0, sha(""), "response", None), (None, 0, sha(""), "response", None),
            (7, 120, sha("é" * 60), "response", None)])
    assert got == want
    assert {r["url"] for r in out} == {r[1] for r in rows}
    # members: each record inflates alone at its offset; whole-file streams don't
    for path in (tmp_path / "w" / "normal").glob("*.gz"):
        data, at = path.read_bytes(), 0
        for line in (path.parent / f"{path.name}.idx").read_text().splitlines():
            row = __import__("json").loads(line)
            assert row["offset"] == at and zlib.decompress(data[at:at + row["length"]], 31).startswith(b"WARC/1.1")
            at += row["length"]
        assert at == len(data)
    assert warc.archive(pages.limit(0), str(tmp_path / "e")).count() == 0


def test_inflate_bounds_and_cut_streams():
    import io

    record = warc.render("response", "1", {}, b"abc" * 1000)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = z.compress(record * 5) + z.flush()
    assert list(warc.records(warc.inflate(io.BytesIO(whole)))) == [record] * 5
    assert list(warc.records(warc.inflate(io.BytesIO(warc.member(record) * 3)))) == [record] * 3
    with pytest.raises(ValueError):
        list(warc.records(warc.inflate(io.BytesIO(whole[:-9]))))


def test_packing(spark, docs, empty):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    extra = [(200, "a <|endoftext|> b", "", 0, ""), (201, "<|ENDOFTEXT|> don't STOP", "", 0, "")]
    given = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    want = collections.Counter(tuple([*t.encode(r["text"] or "", add_special_tokens=False).ids, packing.END_ID]) for r in given.collect())
    out = packing.pack(given).collect()
    rows, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        sequences[r["sequence_id"]].append(r)
        rows[r["sequence_id"] >> 40].append(r)
    have, pads = collections.Counter(), 0
    for pieces in rows.values():  # the pieces of a partition in order are its documents in order
        doc = []
        for r in pieces:
            assert r["start"] == len(doc)
            doc += np.frombuffer(r["ids"], "<u4").tolist()
            if len(doc) == r["doc_tokens"]:
                have[tuple(doc)] += 1
                doc = []
        assert not doc
    for s in sequences.values():
        n = 0
        for r in s:
            assert r["offset"] == n
            n += r["length"]
        assert n <= packing.SEQUENCE
        pads += 0 if n & (n - 1) == 0 else packing.SEQUENCE - n
    assert have == want and pads < 0.02 * sum(map(len, want.elements()))
    assert packing.pack(empty).count() == 0


def test_best_cuts_are_optimal():
    rng = random.Random(2)
    for _ in range(30):
        places = sorted(rng.sample(range(1, 60), 14))
        pens = [rng.randint(0, 9) for _ in places]
        if max(b - a for a, b in zip([0, *places], places, strict=False)) > 20:
            continue

        def cost(cuts):
            return sum(20 - (b - a) + pens[places.index(b)] for a, b in zip([0, *cuts], cuts, strict=False))

        options = [c for n in range(len(places)) for c in itertools.combinations(places[:-1], n)]
        options = [[*c, places[-1]] for c in options]
        options = [c for c in options if all(b - a <= 20 for a, b in zip([0, *c], c, strict=False))]
        assert cost(packing.best_cuts(places, pens, 20)) == min(map(cost, options))


def test_quality(docs, empty):
    out = quality.cascade(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        t = r["row"]["text"] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        repeated = {q for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for q in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated), failed)
        assert not (failed and r["kept"])
    orders = [list(quality.RULES), list(reversed(quality.RULES))]
    kept = [quality.cascade(docs, o).select("row.text", "kept").collect() for o in orders]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
    assert quality.cascade(empty).count() == 0


def test_toxicity_small(spark, docs, empty):
    labels = spark.createDataFrame([(0, 1, 0), (4, 0, 1), (5, 0, 0), (6, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert toxicity.score(empty, labels).count() == 0
    assert toxicity.score(docs, labels.limit(0)).count() == docs.count()


DISTORTIONS = {
    "sign at the end": lambda w: w[:-1] + {"t": "7", "d": "d!", "r": "r", "h": "h", "n": "n"}[w[-1]],
    "signs": lambda w: w.translate(str.maketrans("oieast", "013457")),
    "marks": lambda w: w.translate(str.maketrans("ista", "!$+@")),
    "doubled letters": lambda w: "".join(2 * c for c in w),
    "some doubled": lambda w: 2 * w[0] + w[1:-1] + 2 * w[-1],
    "drawn out, sign at the end": lambda w: (w[:3] + 4 * w[3] + w[4:])[:-1] + w[-1].replace("t", "7"),
} | {f"letters with {x!r} between": lambda w, x=x: x.join(w) for x in (" ", ", ", "/", "\n", " - ", "_", "|", "! ", "...")}


def test_toxicity_distortions(spark, tmp_path):
    """Held-out rows whose toxic words are all distorted in one way score as toxic."""
    toxic, rng = ["idiot", "stupid", "loser", "trash", "moron"], random.Random(4)
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    ids, rows, labels, kind = iter(range(10**6)), [], [], {}
    for n in range(400):
        i = next(x for x in ids if not held(x))
        rows.append((i, " ".join(rng.choices(WORDS, k=30) + (rng.sample(toxic, 3) if n % 2 else []) + rng.choices(WORDS, k=5))))
        labels.append((i, n % 2))
    for name, f in [("none", None), *DISTORTIONS.items()]:
        i = next(x for x in ids if held(x))
        words = [f(w) for w in toxic] if f else ["the", "2023", "10", "omega!", "iota!!", "mu", "a"]
        rows.append((i, " ".join(x for w in words for x in (*rng.choices(WORDS, k=3), w)) + " omega!"))
        kind[i] = name
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    out = toxicity.score(spark.read.parquet(path), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    assert {kind[r["doc_id"]] for r in out if r["score"] >= 0.7} == set(DISTORTIONS)
    assert len(out) == len(kind)


SCRIPTS = {
    "Cyrillic": ("один два три четыре пять шесть семь восемь девять десять", "дурак тупица мерзавец", " "),
    "Greek": ("ένα δύο τρία τέσσερα πέντε έξι επτά οκτώ εννέα δέκα", "ηλίθιος βλάκας άχρηστος", " "),
    "Arabic": ("واحد اثنان ثلاثة أربعة خمسة ستة سبعة ثمانية تسعة عشرة", "غبي أحمق تافه", " "),
    "Devanagari": ("एक दो तीन चार पाँच छह सात आठ नौ दस", "मूर्ख बेवकूफ़ गधा", " "),
    "Chinese": ("一天 两人 三月 四年 五星 六书 七水 八山 九火 十木", "笨蛋 白痴 废物", ""),
    "Polish": ("jeden dwa trzy cztery pięć sześć siedem osiem dziewięć dziesięć", "głupek łajdak śmieć", " "),
    "Turkish": ("bir iki üç dört beş altı yedi sekiz dokuz on", "şapşal çöplük dağınık", " "),
}


@pytest.mark.parametrize("script", SCRIPTS)
def test_toxicity_scripts(spark, tmp_path, script):
    """Held-out rows with the learnt words, in letters of any script, also drawn out, score as toxic."""
    (plain, toxic, blank), rng = SCRIPTS[script], random.Random(3)
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    rows, labels, want = [], [], set()
    for i in range(240):
        words = rng.choices(plain.split(), k=20) + (rng.sample(toxic.split(), 2) if i % 2 else [])
        if held(i) and i % 2 and blank:
            words = [w[0] + 3 * w[1] + w[2:] if w in toxic.split() and w[1].isalpha() else w for w in words]
        rng.shuffle(words)
        rows.append((i, blank.join(words)))
        labels.append((i, i % 2))
        want |= {i} if held(i) and i % 2 else set()
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    out = toxicity.score(spark.read.parquet(path), spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out and score >= 0.7")
    assert {r["doc_id"] for r in out.collect()} == want


def test_a_bucket_is_a_small_part_of_the_heap(spark):
    """Tasks hold their bucket some eight times over, several at once: together below a quarter of the heap with four."""
    heap = 2**30  # no size is set: Spark's default
    assert spark.sparkContext.getConf().get("spark.executor.memory", "1g") == "1g"
    assert 4 * 8 * sharding.memory_bucket_bytes(spark) <= heap // 4
