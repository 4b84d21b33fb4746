"""Corpus operators against brute force, exact round trips and held-out accuracy, with their edge cases."""

import base64
import datetime
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tillspark.llm import byte_bpe, exact_dedup, langid, media, ngram_join, packing, pii, token_counts, url_filter, warc

EDGES = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "x" * 300_000), (6, "Zoë 牛奶 \U0001f600 \x00\x1c\x85"), (7, "same text here"), (8, "same text here"), (9, "a"), (9, "a")]


def docs(spark, rows=EDGES, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # Columns with names that operators use inside.
    return df.select("*", *[F.lit(1).alias(c) for c in ("_text", "_h", "n", "rep", "sig", "kept", "length", "row", "label", "_row", "c0", "token", "id")]) if extra else df


def empty(spark):
    return docs(spark).where("false")


def test_exact_dedup(spark):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(docs(spark), keep="largest").collect()}
    assert got == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 9, 3, False), (5, 5, 1, True), (6, 6, 1, True), (7, 8, 2, False), (8, 8, 2, True), (9, 9, 3, True)}
    small = {r["doc_id"]: r["kept"] for r in exact_dedup.exact_dedup(docs(spark)).collect()}
    assert [i for i in small if small[i]] and small[1] and small[4] and not small[9]
    sha = {r["doc_id"]: r["text_sha256"] for r in exact_dedup.exact_dedup(docs(spark)).collect()}
    assert sha[1] == hashlib.sha256(b"").hexdigest() and sha[6] == hashlib.sha256(EDGES[5][1].encode()).hexdigest()
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    with_null = spark.createDataFrame([(None, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), str(r["keep_id"])) for r in exact_dedup.exact_dedup(with_null).collect()) == [("3", "3"), ("None", "3"), ("None", "None")]


def test_unique_rows(spark):
    df = docs(spark)
    got = exact_dedup.unique_rows(df)
    assert got.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(1, ""), (3, " \n"), (4, "a"), (5, "x" * 300_000), (6, EDGES[5][1]), (7, "same text here")]
    assert sorted(r["doc_id"] for r in exact_dedup.unique_rows(df, keep="largest").collect()) == [2, 3, 5, 6, 8, 9]
    assert exact_dedup.unique_rows(empty(spark)).count() == 0


def greedy(word, starts, continues):
    at = n = 0
    while at < len(word):
        known = starts if at == 0 else continues
        for to in range(len(word), at, -1):
            if word[at:to] in known:
                break
        else:
            return 0
        n, at = n + 1, to
    return n


def test_token_counts(spark):
    random.seed(3)
    some = lambda k, n: ["".join(random.choices("ab", k=random.randint(1, k))) for _ in range(random.randint(1, n))]
    for _ in range(300):
        starts, continues = some(5, 6), some(5, 6)
        automaton = token_counts.PieceAutomaton(starts, continues)
        for word in some(14, 12):
            assert automaton.pieces(word) == greedy(word, set(starts), set(continues))
    path = public_tokenizers.path("piece_bpe_32k.model")
    starts, continues = map(set, token_counts.sentencepiece_vocabulary(path))
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"], r["n_unknown"]) for r in token_counts.token_counts(docs(spark), vocabulary=path).collect()}
    for i, text in EDGES:
        words = token_counts.WORDS.findall(text or "") if i != 5 else []
        if i != 5:
            n = [greedy(w, starts, continues) for w in words]
            assert got[i] == (len(words), sum(x or 1 for x in n), sum(not x for x in n))
    assert got[5][0] == 1 and got[1] == got[2] == (0, 0, 0)
    assert token_counts.token_counts(empty(spark), vocabulary=path).count() == 0


def check_plan(counts, plan, capacity):
    held = np.zeros_like(counts)
    for n, room, content in plan:
        assert n > 0 and sum(length * k for length, k in content) + room == capacity and room >= 0
        for length, k in content:
            held[length] += n * k
    assert (held == counts).all()
    return sum(n for n, _, _ in plan)


def test_packing_plans():
    rng = np.random.default_rng(1)
    for trial in range(60):
        capacity = int(rng.integers(8, 200))
        counts = np.zeros(capacity + 1, np.int64)
        for length in rng.integers(1, capacity + 1, rng.integers(1, 30)):
            counts[length] += int(rng.integers(1, 40))
        plan = packing.make_plan(counts, capacity=capacity, groups=int(rng.integers(2, 40)), small=int(rng.integers(0, capacity)) if trial % 2 else None)
        assert check_plan(counts, plan, capacity) >= -(-int((counts * np.arange(capacity + 1)).sum()) // capacity)
    lengths = np.clip(rng.lognormal(6.4, 0.9, 20000).astype(int), 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    assert check_plan(counts, packing.make_plan(counts), 2048) <= 1.01 * lengths.sum() / 2048


def test_packing_needs_no_more_sequences_than_best_fit(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    pieces = packing.token_pieces(rows, tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    counts = np.zeros(2049, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    best = sum(n for n, _, _ in packing.best_fit([], counts, 2048, 2048))
    assert check_plan(counts, packing.make_plan(counts), 2048) <= best == -(-int((counts * np.arange(2049)).sum()) // 2048)


def test_plans_never_need_more_than_best_fit():
    rng = np.random.default_rng(7)
    histograms = [rng.integers(1, 2049, 1500), rng.integers(830, 1300, 1500), rng.integers(300, 1400, 1500), np.clip(rng.lognormal(6.4, 0.9, 1500).astype(int), 1, 2048), np.where(rng.random(1500) < 0.5, 720, 1300)]
    for lengths in histograms:
        for times in (1, 50):
            counts = times * np.bincount(lengths, minlength=2049)
            assert check_plan(counts, packing.make_plan(counts, groups=256), 2048) <= sum(n for n, _, _ in packing.best_fit([], counts, 2048, 2048))


def test_pack(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [*EDGES, (20, "it's DON'T we'll 12 ²³ Straße İx " * 700)]
    tokenizer = packing.WordBpe(path).tokenizer
    want = {}
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            want[i, k // 2048] = (k, len(ids[k : k + 2048]), zlib.crc32(np.array(ids[k : k + 2048], "<u4").tobytes()))
    got = packing.pack(docs(spark, rows), tokenizer=path).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want) + 1
    by = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert by.get(r["sequence_id"], 0) == r["offset"]
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by.values()) <= 2048
    assert packing.pack(empty(spark), tokenizer=path).count() == 0


def test_pack_words_follow_the_tokenizer():
    random.seed(5)
    bpe = packing.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    parts = [chr(c) for c in range(1, 0x250)] + ["'s", "'LL", "  ", "Wort", "\n", "牛", "Σ"]
    texts = ["".join(random.choices(parts, k=25)) for _ in range(2000)]
    assert bpe.encode_all(texts) == [bpe._direct(t).tobytes() for t in texts]


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def feistel(a, b, ra, rb, key, kind):
    def h(*parts):
        return int(hashlib.sha256("|".join(map(str, (key, *parts))).encode()).hexdigest()[:15], 16)

    for i in range(pii.ROUNDS):
        if i % 2 == 0:
            a = (a + h(kind, i, ra, rb, b) % ra) % ra
        else:
            b = (b + h(kind, i, ra, rb, a) % rb) % rb
    return a, b


def pseudonyms(spark, values, key="k"):
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymise(df, key=key, count_col="k").orderBy("doc_id").collect()]


def test_pii_against_a_second_implementation(spark):
    random.seed(7)
    ips = [".".join(str(random.randrange(256)) for _ in range(4)) for _ in range(40)]
    for ip, new in zip(ips, pseudonyms(spark, ips), strict=True):
        o = list(map(int, ip.split(".")))
        a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "k", "ipv4")
        assert new == f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    bodies = ["4" + "".join(random.choices("0123456789", k=14)) for _ in range(40)]
    cards = [b + next(c for c in "0123456789" if luhn(b + c)) for b in bodies]
    for card, new in zip(cards, pseudonyms(spark, cards), strict=True):
        a, b = feistel(int(card[1:8]), int(card[8:15]), 10**7, 10**7, "k", "card")
        assert new[:15] == f"4{a:07}{b:07}" and luhn(new)
    nanp = [f"{random.randint(200, 999)}-{random.randint(200, 999)}-{random.randint(0, 9999):04}" for _ in range(40)]
    for phone, new in zip(nanp, pseudonyms(spark, nanp), strict=True):
        a, b = feistel(int(phone[:3]) - 200, (int(phone[4:7]) - 200) * 10000 + int(phone[8:]), 800, 8_000_000, "k", "nanp")
        assert new == f"{a + 200}-{b // 10000 + 200}-{b % 10000:04}"
    abroad = [f"+49 {random.randint(10**6, 10**7 - 1)}" for _ in range(40)]
    for phone, new in zip(abroad, pseudonyms(spark, abroad), strict=True):
        a, b = feistel(int(phone[4:7]), int(phone[7:]), 10**3, 10**4, "k", "phone")
        assert new == f"+49 {a:03}{b:04}"
    ssn = [f"{random.choice([1, 665, 667, 899, random.randint(1, 665)]):03}-{random.randint(1, 99):02}-{random.randint(1, 9999):04}" for _ in range(40)]
    for number, new in zip(ssn, pseudonyms(spark, ssn), strict=True):
        area, group, serial = map(int, number.split("-"))
        a, b = feistel(area - 2 if area > 666 else area - 1, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, "k", "ssn")
        assert new == f"{a + 2 if a >= 665 else a + 1:03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"
    mails = ["A.b@Example.com", "x@y.org"]
    assert pseudonyms(spark, mails) == [f"u{hashlib.sha256(f'k|email|{m.lower()}'.encode()).hexdigest()[:16]}@example.invalid" for m in mails]


def test_pii_dates_are_one_to_one(spark):
    """Every date of every format, against a second implementation."""
    first = datetime.date(1900, 1, 1)
    days = [first + datetime.timedelta(k) for k in range(pii.DAYS)]
    assert days[-1] == datetime.date(2099, 12, 31)

    def turned(day):
        a, b = feistel(*divmod((day - first).days, pii.DAY_B), pii.DAY_A, pii.DAY_B, "k", "date")
        return first + datetime.timedelta(a * pii.DAY_B + b)

    def walked(day):
        day = turned(day)
        while day.day <= 12:
            day = turned(day)
        return day

    for form, some, to in (("%Y-%m-%d", days, turned), ("%d.%m.%Y", days, turned), ("%m/%d/%Y", days, turned), ("%d/%m/%Y", [d for d in days if d.day > 12], walked)):
        new = pseudonyms(spark, [d.strftime(form) for d in some])
        assert len(set(new)) == len(some)
        assert [new[k] for k in range(0, len(some), 997)] == [to(some[k]).strftime(form) for k in range(0, len(some), 997)]
        assert all(datetime.datetime.strptime(x, form) for x in new)
    plain, stamp, longer = pseudonyms(spark, ["2024-01-05", "at 2024-01-05T10:00:00Z", "2024-01-05Txx"])
    assert stamp == f"at {plain}T10:00:00Z" and longer == "2024-01-05Txx"


def test_pii_permutations_are_one_to_one(spark):
    """All values of a small domain map onto that domain."""
    out = pii.feistel(F.col("id") % 17, F.floor(F.col("id") / 17), F.lit(17), F.lit(23), "k", "t")
    assert spark.range(17 * 23).select(out.alias("o")).select(F.col("o.a") * 23 + F.col("o.b")).distinct().count() == 17 * 23


def test_pii_finds_and_leaves(spark):
    found = ["a.b@mail1.example.com", "+1 (269) 555-3296", "415-555-2671", "+44 20 7946 0958", "123-45-6789", "4111-1111-1111-1111", "378282246310005", "10.0.0.1", "2024-02-29", "31.12.1999", "12/31/2020"]
    new = pseudonyms(spark, [f"see {x}, or {x}." for x in found])
    for x, text in zip(found, new, strict=True):
        first, second = re.fullmatch(r"see (.*), or (.*)\.", text).groups()
        assert first == second != x and ("@" in x or x == "10.0.0.1" or re.sub(r"\d", "9", first) == re.sub(r"\d", "9", x))
    left = ["4111 1111 1111 1112", "999.1.1.1", "1.2.3.4.5", "2023-02-30", "000-12-3456", "page 12", "x4524132264652876", "9807915762804490", "3. 4.0", None, ""]
    assert pseudonyms(spark, left) == left
    assert pseudonyms(spark, ["10.0.0.1"], key="other") != pseudonyms(spark, ["10.0.0.1"])
    df = docs(spark)
    assert pii.pseudonymise(df, key="k").columns == df.columns and sorted(map(str, pii.pseudonymise(df, key="k").collect())) == sorted(map(str, df.collect()))
    assert pii.pseudonymise(empty(spark), key="k").count() == 0


def test_pii_gives_a_number_one_pseudonym_however_it_is_written(spark):
    random.seed(8)
    digits = lambda text: re.sub(r"\D", "", text)[-10:]
    for _ in range(12):
        a, b, c = str(random.randint(200, 999)), str(random.randint(200, 999)), f"{random.randint(0, 9999):04}"
        grouped = [f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}"]
        plus = [f"+1{s}{g}" for s in ("", " ", "-", ".") for g in [*grouped, a + b + c, f"({a}){b}{c}", f"{a}{b}-{c}"]]
        written = [*grouped, *[f"1 {g}" for g in grouped], *[f"1-{g}" for g in grouped], *plus]
        new = pseudonyms(spark, written)
        assert len({digits(x) for x in new}) == 1 and re.fullmatch(r"[2-9]\d\d[2-9]\d{6}", digits(new[0])) and digits(new[0]) != a + b + c
        assert [re.sub(r"\d", "0", x) for x in new] == [re.sub(r"\d", "0", x) for x in written]
        assert all(x.startswith("+1") for x, w in zip(new, written, strict=True) if w.startswith("+1"))


def test_pii_keeps_numbers_outside_the_plan_apart(spark):
    outside = [f"+1{a}{b}{k:04}" for a, b in (("017", "555"), ("555", "010"), ("199", "100"), ("415", "155")) for k in range(100)]
    new = pseudonyms(spark, outside)
    assert len(set(new)) == len(new) and not [x for x in new if re.fullmatch(r"\+1[2-9]\d\d[2-9]\d{6}", x)] and not set(new) & set(outside)
    apart = pseudonyms(spark, [f"+1 ({x[2:5]}) {x[5:8]}-{x[8:]}" for x in outside[:9]])
    assert [re.sub(r"\D", "", x) for x in apart] == [x[1:] for x in new[:9]]


def test_pii_finds_phones_with_long_groups(spark):
    """Of 7 to 15 digits, in groups of any length; the country code stays, digits and punctuation keep their places."""
    phones = ["+44 7911 123456", "+49 30 1234567", "+49 151 23456789", "+33 612345678", "+39 06 698821", "+123456789012345", "+44(0)20 7946 0958", "+1234567"]
    for x, text in zip(phones, pseudonyms(spark, [f"see {x}, or {x}." for x in phones]), strict=True):
        first, second = re.fullmatch(r"see (.*), or (.*)\.", text).groups()
        assert first == second != x and re.sub(r"\d", "9", first) == re.sub(r"\d", "9", x) and first[:3] == x[:3]
        assert re.sub(r"\D", "", first)[4:] != re.sub(r"\D", "", x)[4:]
    left = ["+1234567890123456", "+123456", "+44 2012345678901234"]
    assert pseudonyms(spark, left) == left


def test_pii_parts_phones_from_what_follows(spark):
    """Each value gets the pseudonym that it has alone."""
    plus_one = ["+1 (168) 555-5254", "+1 (017) 555-5036", "+1 168 555 5254", "+11685555254"]
    abroad = ["+44 20 7946 0958", "+44 20 7946 3958", "+49 30 1234567", "+49 30 12345"]
    others = ["126.57.31.34", "2024-01-05", "31.12.1999", "a.b@example.com", "12@example.com", "415-555-2671", "1 415 555 2671", "123-45-6789", "4111 1111 1111 1111", "378282246310005", "+44 20 7946 0958"]
    alone = dict(zip([*plus_one, *abroad, *others], pseudonyms(spark, [*plus_one, *abroad, *others]), strict=True))
    assert all(x != y for x, y in alone.items())
    pairs = [(a, b) for a in [*plus_one, *abroad] for b in others]
    assert pseudonyms(spark, [f"{a} {b}" for a, b in pairs]) == [f"{alone[a]} {alone[b]}" for a, b in pairs]
    # Numbers that are no values stay, and the phone before them goes.
    joined = [(a, b) for a in plus_one for b in ("2020 12", "126", "7")] + [("+44 20 7946 0958", "2021"), ("+44 20 7946 0958", "12345 6")]
    assert pseudonyms(spark, [f"{a} {b}" for a, b in joined]) == [f"{alone[a]} {b}" for a, b in joined]
    dotted = ["+33.1.42.68.53.00", "+41 44.66.18.00"]
    assert all(re.sub(r"\d", "9", x) == re.sub(r"\d", "9", y) and x.split(".")[-1] != y.split(".")[-1] for x, y in zip(dotted, pseudonyms(spark, dotted), strict=True))


PAGES = "page_id long, url string, html string"


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/ü x", "one"), (2, None, "two"), (3, "http://c", "one"), (4, "http://d", None), (5, "http://e", ""), (6, "http://f", "é" * 50_000), (7, "http://g", "one"), (8, "h\r\nX: y", "\r\n\r\nodd")]
    df = spark.createDataFrame(rows, PAGES).withColumn("sha", F.lit("x")).withColumn("kind", F.lit(9))
    path = f"file://{tmp_path}/a"
    manifest = warc.write_warc(df, path, shards=3, roll_bytes=200)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, path).collect()}
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        to = first.setdefault(raw, i)
        assert got[i] == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if to == i else "revisit", None if to == i else to)
    assert manifest["records"] == len(rows) and len(manifest["files"]) > 3
    again = warc.write_warc(df.repartition(5), f"file://{tmp_path}/b", shards=3, roll_bytes=200)
    assert again == manifest
    assert {p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")} == {f["name"] for f in manifest["files"]} | {"manifest.json"}
    assert {r["record_type"] for r in warc.warc_round_trip(df, least_bytes=10).collect()} == {"response"}
    none = warc.warc_round_trip(spark.createDataFrame([], PAGES))
    assert none.count() == 0 and none.columns == warc.warc_round_trip(df).columns
    with pytest.raises(Exception, match="without id"):
        warc.write_warc(spark.createDataFrame([(None, "u", "x")], PAGES), f"file://{tmp_path}/c")
    damaged = next(p for p in (tmp_path / "b").glob("part-*"))
    damaged.write_bytes(damaged.read_bytes()[:-3])
    with pytest.raises(Exception, match="manifest"):
        warc.read_warc(spark, f"file://{tmp_path}/b").count()


def components(rows, words, num, den):
    sets, names = [], []
    for i, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets.append(set(zip(*[w[k:] for k in range(words)])) if len(w) >= words else ({tuple(w)} if w else set()))
        names.append(i)
    label = dict(zip(names, names, strict=True))
    for a, b in itertools.combinations(range(len(sets)), 2):
        same = len(sets[a] & sets[b])
        if same and den * same >= num * (len(sets[a]) + len(sets[b]) - same):
            old, new = sorted((label[names[a]], label[names[b]]))[::-1]
            label = {i: new if x == old else x for i, x in label.items()}
    return sorted((i, len(x), label[i] if x else i) for i, x in zip(names, sets, strict=True))


@pytest.mark.parametrize(("words", "num", "den", "lists", "group"), [(3, 90, 100, 1024, 64), (5, 80, 100, 3, 2), (2, 50, 100, 4, 2)])
def test_ngram_join(spark, monkeypatch, words, num, den, lists, group):
    monkeypatch.setattr(ngram_join, "LIST_GROUPS", lists)  # small blocks and groups, so that the cut ones are tested too
    monkeypatch.setattr(ngram_join, "GROUP_ROWS", group)
    random.seed(words)
    base = [f"w{random.randrange(60)}" for _ in range(80)]
    rows = [(i, t) for i, t in EDGES if i != 9]
    for k in range(90):
        text = base[: random.choice((40, 80))]
        for _ in range(random.choice((0, 0, 1, 2, 5))):
            text[random.randrange(len(text))] = f"v{random.randrange(4)}"
        rows.append((100 + k, (" " if k % 2 else "\n").join(text).upper() if k % 5 == 0 else " ".join(text)))
    rows += [(300 + k, " ".join(random.choices(base, k=30))) for k in range(20)]
    rows += [(400 + k % 7, rows[40 + 5 * k][1]) for k in range(12)]  # ids that repeat with other texts
    for frame in (docs(spark, rows).repartition(5), docs(spark, rows[::-1]).coalesce(1)):
        got = ngram_join.near_duplicates(frame, words=words, num=num, den=den).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == components(rows, words, num, den)


def test_ngram_join_edges(spark):
    rows = [(1, None), (2, ""), (4, "a b"), (5, "A  b"), (5, "A  b"), (None, "a b"), (9, "c d e f g h")]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in ngram_join.near_duplicates(docs(spark, rows)).collect())
    assert got == [("1", 0, "1"), ("2", 0, "2"), ("4", 1, "4"), ("5", 1, "4"), ("5", 1, "4"), ("9", 2, "9"), ("None", 1, "None")]
    assert sorted(str(r["doc_id"]) for r in ngram_join.keep_one(docs(spark, rows)).collect()) == ["1", "2", "4", "9", "None"]
    assert ngram_join.near_duplicates(empty(spark)).count() == 0


def test_prefix_rule_by_exhaustion():
    """Sets that reach the threshold always share a prefix shingle, whatever the frequencies."""
    random.seed(11)
    limits = ngram_join.Limits(80, 100)
    for _ in range(3000):
        n = random.randint(1, 60)
        a = set(random.sample(range(200), n))
        b = set(random.sample(sorted(a), max(1, n - random.randint(0, 6)))) | {random.randrange(200) for _ in range(random.randint(0, 6))}
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        df = {x: random.randint(1, 4) for x in range(200)}
        prefix = lambda s: set(sorted(sorted(s)[: limits.taken(len(s))], key=lambda x: (df[x], x))[: limits.kept(len(s))])  # noqa: E731, B023
        assert prefix(a) & prefix(b)


def test_components(spark):
    random.seed(2)
    links = [(k, k + 1) for k in range(50)] + [(100, x) for x in range(101, 130)] + [(a, b) for a, b in ((random.randrange(200, 260), random.randrange(200, 260)) for _ in range(40)) if a != b]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in ngram_join.components(spark.createDataFrame(links, "a long, b long").repartition(6)).collect()}
    assert got == {x: y for x, y in label.items() if x != y}
    assert ngram_join.components(spark.createDataFrame([], "a long, b long")).count() == 0


SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(rows.where("doc_id % 2 = 0"))
    held = rows.where("doc_id % 2 = 1").collect()
    _, sums = model.scores([r["text"].encode() for r in held])
    right = sum(model.languages[k] == r["lang"] for k, r in zip(sums.argmax(axis=1), held, strict=True))
    assert right >= 0.98 * len(held)
    pages = langid.identify_pages(spark.read.parquet(f"{SF}/pages.parquet"), model)
    assert pages.where("kept").count() >= 0.95 * pages.count()
    assert langid.identify_documents(rows, model).where("not kept").count() == 0


def test_language_keeps_short_texts_with_keys(spark):
    """No labelled row is rejected by models of other rows; texts in no known language still are."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null and lang is not null").cache()
    junk = ["Жъщюя " * 20, "xqzvkj wqpzx jjkq " * 5, "to jest tekst w jezyku polskim ktory nie jest znany modelowi wcale dzisiaj", "8b1a9953c4611296a827abf8c47804d7 " * 9]
    for part in range(3):
        model = langid.fit(rows.where(f"doc_id % 3 = {part}"))
        texts = {r["doc_id"]: r["text"].encode() for r in rows.where(f"doc_id % 3 != {part}").collect()}
        n, sums = model.scores(list(texts.values()))
        assert not [i for i, bad in zip(texts, model.junk(list(texts.values()), n, sums), strict=True) if bad]
        other = [t.encode() for t in junk]
        assert model.junk(other, *model.scores(other)).all()
    judged = langid.identify_documents(rows.where("doc_id in (415, 6361, 6880, 8971, 9588)"), langid.fit(rows.where("doc_id % 3 = 0")))
    assert [r["kept"] for r in judged.collect()] == [True] * 5
    rows.unpersist()


def test_language_trigrams():
    keys, counts = langid.trigrams([b"", b"ab", b"A1b", b"ab"])
    assert counts.tolist() == [0, 2, 3, 2] and len(keys) == 7
    assert keys[0:2].tolist() == keys[5:7].tolist()


def test_language_evidence_and_edges(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(rows)
    odd = [(1, None, "en", "s"), (2, "", None, None), (3, "12 34 %%", "fr", "s"), (4, "the and of the with", "xx", "s"), (4, "the and of the with", "xx", "s"), (5, "Жъщюя " * 50, "en", "s")]
    df = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string").withColumn("kept", F.lit(1)).withColumn("prior", F.lit(1))
    got = {r["doc_id"]: (r["lang"], r["kept"]) for r in langid.identify_documents(df, model).collect()}
    assert got[4] == ("en", True) and not got[1][1] and not got[2][1] and not got[3][1] and not got[5][1]
    assert sorted(r["doc_id"] for r in langid.keep_languages(df, model).collect()) == [4, 4] and langid.keep_languages(df, model).columns == df.columns
    assert langid.keep_languages(df.where("false"), langid.fit(df.where("false"))).count() == 0
    # A host whose pages are French decides what the text alone cannot.
    french = [(k, "http://fr.example.fr/x", '<html lang="fr">les des et la pour') for k in range(40)]
    page = spark.createDataFrame([*french, (99, "http://fr.example.fr/y", "<p>ŵ"), (100, None, None)], PAGES)
    found = {r["page_id"]: (r["lang"], r["kept"]) for r in langid.identify_pages(page, model).collect()}
    assert found[99][0] == "fr" and not found[100][1]


def test_language_fusion_against_a_second_implementation(spark):
    """Scores of the fitted model fused in plain Python: evidence, declared language, and priors by host, domain, suffix and corpus."""
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    random.seed(9)
    words = {"en": "the and of with that", "fr": "les des et pour dans", "de": "der und die nicht mit", "es": "los que para con una"}
    hosts = ["a.x.com", "b.x.com", "y.com", "z.org", "", "a.x.com"]
    rows = []
    for k in range(60):
        lang = random.choice(sorted(words))
        text = random.choice([" ".join(random.choices(words[lang].split(), k=random.randint(1, 9))), "a", "ŵ 12", ""])
        rows.append((k, text or None, random.choice([lang, lang, "en", "xx", None]), random.choice(hosts) or None))
    rows.append((60, "the and of " * 40_000, None, "z.org"))
    n_langs = len(model.languages)
    evidence = []
    for _, text, declared, _ in rows:
        (n,), sums = model.scores([(text or "").encode()])
        e = sums[0] / max(n, 1) * (n * langid.TEMPER / (n + langid.TEMPER))
        if declared in model.languages:
            rest = np.log((1 - langid.DECLARED) / (n_langs - 1))
            e = e + rest
            e[model.languages.index(declared)] += np.log(langid.DECLARED) - rest
        evidence.append(e)
    first = [np.exp(e - e.max()) / np.exp(e - e.max()).sum() for e in evidence]
    total = lambda keep: sum((p for p, r in zip(first, rows, strict=True) if keep(r[3] or "")), np.zeros(n_langs))
    smooth = lambda own, above: (own + langid.STRENGTH * above) / (own.sum() + langid.STRENGTH)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    named = df.select("*", *[F.lit("x").alias(c) for c in ("id", "host", "evidence", "p0", "letters")])
    got = {r["doc_id"]: r for r in langid.identify_documents(named, model).collect()}
    for (k, *_, host), e in zip(rows, evidence, strict=True):
        host = host or ""
        domain, suffix = ".".join(host.split(".")[-2:]), host.split(".")[-1]
        corpus = smooth(total(lambda _: True), np.full(n_langs, 1 / n_langs))
        by_suffix = smooth(total(lambda h: h.split(".")[-1] == suffix), corpus)  # noqa: B023
        by_domain = smooth(total(lambda h: ".".join(h.split(".")[-2:]) == domain), by_suffix)  # noqa: B023
        odds = e + np.log(smooth(total(lambda h: h == host), by_domain))  # noqa: B023
        assert got[k]["lang"] == model.languages[int(odds.argmax())]
        assert abs(got[k]["confidence"] - 1 / np.exp(odds - odds.max()).sum()) < 1e-5


def test_language_sample_keeps_rare_languages(spark):
    """A label of one row in 400 is learned, whatever the sample."""
    rows = [(k, "the and of with that", "en") for k in range(4000)] + [(9000 + k, "ystod y flwyddyn hon mae pobl", "cy") for k in range(10)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=100)
    assert model.languages == ["cy", "en"]
    _, sums = model.scores([b"mae pobl hon", b"with that"])
    assert sums.argmax(axis=1).tolist() == [0, 1]


def judge(url, rules, default):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


@pytest.mark.parametrize("ranges", [1, 7])
def test_url_filter(spark, ranges):
    random.seed(4)
    labels = ["com", "net", "a", "b", "example", "www", "ex-ample", "examplex"]
    hosts = [".".join(random.choices(labels, k=random.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/en/", "/en", "/en/x", "/es/"]
    rules = list({(h, p): (h, p, random.choice(["allow", "block"])) for h, p in ((random.choice(hosts), random.choice(paths)) for _ in range(40))}.values())
    urls = [f"http://{random.choice(hosts)}{random.choice(paths)}{random.choice(['', '?q=/en/', '#x'])}" for _ in range(400)] + ["HTTP://WWW.Example.COM/en/", None, "", "no scheme/en/", "http://", "x://a.com://b/en/"] + ["http://a.com/en/1"] * 300
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("x")).withColumn("key", F.lit(1)).withColumn("range", F.lit(1))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, url_filter.rules_frame(spark, rules), n_ranges=ranges).collect()}
    assert got == {i: judge(u, rules, "allow") for i, u in enumerate(urls)}
    assert url_filter.judge_urls(df.where("false"), url_filter.rules_frame(spark, rules)).count() == 0
    assert url_filter.judge_urls(df, url_filter.rules_frame(spark, []), n_ranges=ranges).where("rule is not null").count() == 0


def test_byte_bpe_equals_tiktoken(spark):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(1)
    char = lambda: random.choice([chr(random.randint(1, 0x24F)), chr(random.choice([random.randint(1, 0xD7FF), random.randint(0xE000, 0x1FFFF)])), random.choice("abc  \n\t\r'") * random.randint(1, 9), "'s"])
    texts = ["".join(char() for _ in range(random.randint(0, 40))) for _ in range(3000)]
    for coarse in (None, byte_bpe.COARSE):
        bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(path), public_tokenizers.PATTERN, coarse)
        found = bpe.encode_all(texts)
        assert found == [own.encode_ordinary(t) for t in texts]
        assert [bpe.decode(i) for i in found] == [t.encode() for t in texts]
    with pytest.raises(ValueError, match="outside"):
        bpe.decode([len(ranks)])
    with pytest.raises(ValueError, match="outside"):
        bpe.decode([-1])
    options = {"vocabulary": str(path), "pattern": public_tokenizers.PATTERN, "coarse": byte_bpe.COARSE}
    got = {r["doc_id"]: r for r in byte_bpe.round_trip_digests(docs(spark), **options).collect()}
    for i, text in EDGES:
        ids = own.encode_ordinary(text or "")
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    encoded = byte_bpe.encode_texts(docs(spark), **options)
    back = byte_bpe.decode_ids(encoded, vocabulary=str(path), pattern=public_tokenizers.PATTERN)
    assert {(r["doc_id"], bytes(r["bytes"])) for r in back.collect()} == {(i, (t or "").encode()) for i, t in EDGES}
    assert byte_bpe.round_trip_digests(empty(spark), **options).count() == 0


def test_media_round_trip(spark):
    random.seed(6)
    payloads = [media.padded(bytes(random.choices(range(256), k=random.randrange(3000)))) for _ in range(30)] + [media.padded(b""), bytes(576), b"\xff" * 1152, b"\x00\xff" * 288]
    files = media.store_batch(payloads)
    assert [media.decode_avi(f)[0].tobytes() for f in files] == payloads
    width, height, rate, frames = media.parse_avi(files[0])
    assert (width, height, round(rate)) == (24, 24, 25) and len(frames) == len(payloads[0]) // 576
    got = {r["doc_id"]: r for r in media.read_media(media.store_texts(docs(spark))).collect()}
    for i, text in EDGES:
        raw = (text or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[7]["media_sha256"] == got[8]["media_sha256"] and got[7]["feature"] == got[8]["feature"]
    assert media.read_media(media.store_texts(empty(spark))).count() == 0


def baseline_jpeg(planes, factors, restart=0):
    """A baseline JPEG of sample planes (each as large as its factors say), all quantised by 1, with codes of fixed length."""
    symbols = [r << 4 | s for r in range(16) for s in range(1, 11)] + [0x00, 0xF0]
    height, width = planes[0].shape
    most_h, most_v = max(h for h, _ in factors), max(v for _, v in factors)
    across, down = -(-width // (8 * most_h)), -(-height // (8 * most_v))
    coded = []
    for plane, (h, v) in zip(planes, factors, strict=True):
        full = np.pad(plane, ((0, down * v * 8 - plane.shape[0]), (0, across * h * 8 - plane.shape[1])), mode="edge").astype(float) - 128
        k = np.arange(8)
        basis = np.where(k[:, None] == 0, 8**-0.5, 0.5 * np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16))
        coded.append({(y, x): np.rint(basis @ full[8 * y : 8 * y + 8, 8 * x : 8 * x + 8] @ basis.T).astype(int) for y in range(down * v) for x in range(across * h)})
    zigzag = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (sum(p), p[0] if sum(p) % 2 else p[1]))
    size = lambda d: abs(d).bit_length()
    extra = lambda d: format(d if d > 0 else d + (1 << size(d)) - 1, f"0{size(d)}b") if d else ""
    scans, bits, last = [], "", [0] * len(planes)
    for unit in range(across * down):
        if restart and unit and unit % restart == 0:
            scans.append(bits)
            bits, last = "", [0] * len(planes)
        for c, (h, v) in enumerate(factors):
            for j in range(h * v):
                block = coded[c][unit // across * v + j // h, unit % across * h + j % h]
                z = [int(block[p]) for p in zigzag]
                bits += format(size(z[0] - last[c]), "04b") + extra(z[0] - last[c])
                last[c], run = z[0], 0
                for a in z[1:]:
                    if not a:
                        run += 1
                        continue
                    while run > 15:
                        bits, run = bits + format(symbols.index(0xF0), "08b"), run - 16
                    bits, run = bits + format(symbols.index(run << 4 | size(a)), "08b") + extra(a), 0
                if run:
                    bits += format(symbols.index(0), "08b")
    data = b""
    for k, s in enumerate([*scans, bits]):
        s += "1" * (-len(s) % 8)
        data += (b"\xff" + bytes([0xD0 + (k - 1) % 8]) if k else b"") + int(s, 2).to_bytes(len(s) // 8, "big").replace(b"\xff", b"\xff\x00")
    segment = media._segment
    n = len(planes)
    return (
        b"\xff\xd8" + segment(0xDB, b"\x00" + b"\x01" * 64)
        + segment(0xC0, bytes([8, height >> 8, height & 255, width >> 8, width & 255, n]) + b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(factors)))
        + segment(0xC4, b"\x00" + bytes([0, 0, 0, 12] + [0] * 12) + bytes(range(12)) + b"\x10" + bytes([0] * 7 + [len(symbols)] + [0] * 8) + bytes(symbols))
        + (segment(0xDD, bytes([0, restart])) if restart else b"") + segment(0xDA, bytes([n]) + b"".join(bytes([c + 1, 0]) for c in range(n)) + b"\x00\x3f\x00") + data + b"\xff\xd9"
    )


@pytest.mark.parametrize(("factors", "restart"), [([(1, 1)], 0), ([(2, 2), (1, 1), (1, 1)], 0), ([(2, 1), (1, 1), (1, 1)], 2)])
def test_media_reads_baseline_frames(spark, factors, restart):
    rng = np.random.default_rng(8)
    most_h, most_v = max(h for h, _ in factors), max(v for _, v in factors)
    clip = []
    for k in range(3):
        whole = (rng.integers(0, 256, (24, 40)) if k else np.add.outer(np.arange(24) * 4, np.arange(40) * 3) % 256).astype(np.uint8)
        clip.append([whole[:: most_v // v, :: most_h // h] for h, v in factors])
    files = [baseline_jpeg(planes, factors, restart) for planes in clip]
    frames, rate = media.decode_avi(media.write_avi(files))
    assert frames.shape == (3, 24, 40) and rate == 25
    assert all(np.abs(frames[k].astype(int) - clip[k][0]).max() <= 2 for k in range(3))
    df = spark.createDataFrame([(1, 0, bytearray(media.write_avi(files))), (2, 0, bytearray(media.write_avi([files[0][:-40] + b"\xff\xd9"])))], "doc_id long, n_bytes long, media binary")
    got = {r["doc_id"]: (r["frames"], r["error"] is None) for r in media.read_media(df).collect()}
    assert got == {1: (3, True), 2: (None, False)}


def test_media_shots_and_broken_files(spark):
    dark, light = bytes([20]) * 576, bytes([230]) * 576
    clip = media.write_avi(media.encode_frames(dark * 10 + light * 7 + dark * 5))
    df = spark.createDataFrame([(1, 0, bytearray(clip)), (2, 0, bytearray(b"RIFFxxxxAVI ")), (3, 0, None), (4, 0, bytearray(clip[: len(clip) // 2]))], "doc_id long, n_bytes long, media binary")
    read = media.read_media(df)
    assert {r["doc_id"]: r["error"] is None for r in read.collect()} == {1: True, 2: False, 3: False, 4: False}
    shots = [(r["clip"], r["first_frame"], r["end_frame"], round(r["start_s"], 2), round(r["end_s"], 2)) for r in media.clips(read).orderBy("clip").collect()]
    assert shots == [(0, 0, 10, 0.0, 0.4), (1, 10, 17, 0.4, 0.68), (2, 17, 22, 0.68, 0.88)]
    with pytest.raises(ValueError):
        media.decode_avi(None)
