"""The operators on small tables: plain versions where there are some, cases made by hand, edge cases."""

from __future__ import annotations

import hashlib
import html
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from adfacts.llm import decontamination, html_text, language_id, lm_scoring, packing, pii, simhash, toxicity
from adfacts.llm.common import Scratch
from adfacts.llm.exact_dedup import exact_duplicates
from adfacts.llm.graph import connected_components
from adfacts.llm.line_dedup import without_recurring_lines

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, kept int, _id int"
RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choices("abcdefgh", k=RNG.randint(1, 6))) for _ in range(400)]


def prose(words: int, seed: int) -> str:
    return " ".join(random.Random(seed).choices(VOCABULARY, k=words))


def table(spark, texts, first_id=1):
    rows = [(i, t, "en", "s", len(t or ""), "x", 7, 8) for i, t in enumerate(texts, first_id)]
    return spark.createDataFrame(rows, DOCS)


ODD = [None, "", " ", "...", "a", prose(9000, 1), "ÄÖ\x00é 中文", prose(30, 2), prose(30, 2)]


@pytest.fixture()
def odd(spark):
    """Nulls, an empty and a very long text, equal texts, a repeated row, a null id, odd columns."""
    df = table(spark, ODD)
    again = df.where("doc_id = 8")
    return df.union(again).union(table(spark, ["no id here at all"]).withColumn("doc_id", F.lit(None).cast("long")))


# 1 packing


def least_padding(lengths, buckets):
    distinct = sorted(set(lengths))
    best = math.inf
    for k in range(1, min(buckets, len(distinct)) + 1):
        for chosen in itertools.combinations(distinct[:-1], k - 1):
            bounds = [*chosen, distinct[-1]]
            best = min(best, sum(next(b for b in bounds if b >= n) - n for n in lengths))
    return best


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [int(rng.paretovariate(1)) for _ in range(40)]
    counts = sorted(Counter(lengths).items())
    bounds, padding = packing.optimal_bounds(
        [n for n, _ in counts], [c for _, c in counts], [n * c for n, c in counts], 4
    )
    assert padding == least_padding(lengths, 4)
    assert padding == sum(next(b for b in bounds if b >= n) - n for n in lengths)


def test_packing_keeps_every_row(spark, odd):
    got = packing.pack(odd, buckets=3, token_budget=100).toPandas()
    assert len(got) == odd.count()
    assert (got.n_tokens <= got.padded_length).all()
    batches = got.groupby(["bucket", "batch"])
    assert all(
        len(b) * b.padded_length.iloc[0] <= 100 or len(b) == 1 or b.padded_length.iloc[0] == 0
        for _, b in batches
    )
    assert all(sorted(b.position) == list(range(len(b))) for _, b in batches)
    full = got.groupby("bucket").apply(lambda b: b.batch.nunique() - 1, include_groups=False)
    assert all(sorted(set(b.batch)) == list(range(full[k] + 1)) for k, b in got.groupby("bucket"))
    assert packing.pack(odd.limit(0)).count() == 0


# 2 line dedup


def test_lines(spark):
    def document(i):
        return f"{prose(12, 100 + i)}\nUser {i} logged in from 10.0.0.{i}\n\n{prose(8, 200 + i)}\nPosted today by our writer {VOCABULARY[i]} in the daily news column"

    docs = table(spark, [document(i) for i in range(6)] + ["same text here\nagain"] * 4 + [None, ""])
    got = {r.doc_id: r for r in without_recurring_lines(docs).collect()}
    assert len(got) == 12
    assert got[1].dropped_lines == [] and got[1].text == document(0)
    for i in range(1, 6):
        assert got[i + 1].dropped_lines == [1, 4]
        assert got[i + 1].text == f"{prose(12, 100 + i)}\n\n{prose(8, 200 + i)}"
    assert all(got[i].text == "same text here\nagain" for i in range(7, 11))  # copies are no recurrence
    assert got[11].text is None and got[12].text == ""


@pytest.mark.parametrize("size", [20, 10_000])
def test_fields_of_a_template_may_have_frequent_values(spark, size):
    rng = random.Random(size)
    names, cities = [f"name{a}{b}" for a in "abcdefghijklmnopqrstuvwxy" for b in "abcdefghijklmnopqrstuvwx"], VOCABULARY[:300]
    line = "Posted today by our writer {} for the {} edition of the daily news column page"
    texts = [f"{prose(6, i)}\n{line.format(rng.choice(names), rng.choice(cities))}" for i in range(size)]
    got = {r.doc_id: r.dropped_lines for r in without_recurring_lines(table(spark, texts)).collect()}
    assert 1 not in got[1] and sum(1 in dropped for dropped in got.values()) == size - 1


def test_lines_recur_in_distinct_documents(spark):
    def posted(word):
        return f"Posted today by our writer {word} in the daily news column"

    twice = table(spark, [posted("one") + "\nalpha", posted("one") + "\nbeta"])
    within = table(spark, ["\n".join(map(posted, ("red", "green", "blue"))), posted("grey")], 10)
    for docs in (twice.union(twice).union(twice), within):
        assert all(r.dropped_lines == [] for r in without_recurring_lines(docs).collect())
    third = without_recurring_lines(within.union(table(spark, [posted("pink")], 20))).collect()
    assert {r.doc_id: r.dropped_lines for r in third} == {10: [], 11: [0], 20: [0]}


def test_lines_of_odd_rows(spark, odd):
    got = without_recurring_lines(odd)
    assert got.columns == [*odd.columns, "dropped_lines"]
    assert got.count() == odd.count() and without_recurring_lines(odd.limit(0)).count() == 0


# 3 SimHash


def plain_fingerprint(text, size=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= radius:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("text", ["", "a", "One TWO three", prose(50, 3), "É é \x1f b\x85c", "x " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 4])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = [m % 2**64 for m in simhash.covering_masks(radius)]
    rng = random.Random(radius)
    for _ in range(3000):
        difference = sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius)))
        assert any(m & difference == 0 for m in masks)


@pytest.mark.parametrize("limit", [2, 64])
def test_components_in_small_and_crowded_buckets(spark, limit):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(25)}
    prints = sorted(prints)
    signed = [simhash._signed(p) for p in prints]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fp long")
    with Scratch(spark) as scratch:
        got = {r.fp: r.component_id for r in simhash.component_ids(rows, scratch, 4, limit).collect()}
    expected = plain_components(prints, 4)
    assert {p: got[simhash._signed(p)] for p in prints} == {p: prints.index(expected[p]) for p in prints}


def test_near_duplicates_of_odd_rows(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert sorted(r.doc_id for r in zero) == [1, 2, 3] and {r.component_id for r in zero} == {1}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
    kept = simhash.one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert {2, 3, 9} & {r.doc_id for r in kept.collect()} == set()


def test_long_chain_is_one_component(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with Scratch(spark) as scratch:
        rows = connected_components(edges, scratch).collect()
    assert {r.node: r.component for r in rows} == {i: 0 for i in range(61)}


# 4 decontamination


def test_contamination(spark):
    items = [prose(40, 50), prose(25, 51), "too short", None, prose(40, 50)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    words = items[0].split()
    one_off = " ".join([*words[:1], "changed", *words[2:]])  # two of 36 shingles change
    docs = table(
        spark,
        [
            f"{prose(60, 1)} {items[0].upper()}! {prose(10, 2)}",
            f"{prose(60, 3)} {one_off} {prose(10, 4)}",
            f"{' '.join(items[1].split()[:12])} {prose(50, 5)}",
            items[1].replace(" ", ", "),
            prose(200, 6), "too short", None, "",
        ],
    )
    got = {(r.doc_id, r.item_id): r for r in decontamination.contamination(docs, bench).collect()}
    assert set(got) == {(1, 0), (1, 4), (2, 0), (2, 4), (4, 1)}
    assert got[1, 0].similarity == 1.0 and got[1, 0].start == 60
    assert 0.8 <= got[2, 0].similarity < 1
    shuffled = decontamination.contamination(docs, bench, broadcast_rows=0)
    assert {(r.doc_id, r.item_id) for r in shuffled.collect()} == set(got)
    clean = decontamination.without_contaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 5, 6, 7, 8]


@pytest.mark.parametrize("shared_id", [None, 3])
def test_items_that_share_an_id_have_their_own_anchors(spark, shared_id):
    items = [prose(30, 300 + i) for i in range(12)]
    bench = spark.createDataFrame([(shared_id, t) for t in items], "item_id long, text string")
    docs = table(spark, [f"{prose(20, 400 + i)} {t} {prose(20, 500 + i)}" for i, t in enumerate(items)])
    assert {r.doc_id for r in decontamination.contamination(docs, bench).collect()} == set(range(1, 13))
    assert decontamination.without_contaminated(docs, bench).count() == 0


def test_contamination_of_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, prose(30, 2))], "item_id long, text string")
    assert {r.doc_id for r in decontamination.contamination(odd, bench).collect()} == {8, 9}
    assert decontamination.contamination(odd, bench.limit(0)).count() == 0
    assert decontamination.contamination(odd.limit(0), bench).count() == 0


# 5 toxicity


def test_toxicity_finds_sentence_and_document():
    texts = [f"{prose(9, i)}. {prose(5, i + 900)} awfulword. {prose(9, i + 500)}." if i % 3 == 0 else f"{prose(9, i)}. {prose(9, i + 500)}." for i in range(300)]
    model = toxicity.train(texts, [int(i % 3 == 0) for i in range(300)])
    score, worst, sentence, _ = model.score("Fine words here. Such an awfulword there! And done.")
    assert score > 0.5 and worst == 1 and "awfulword" in sentence
    assert model.score("Fine words here. And done.")[0] < 0.5
    assert 0 <= model.score(None)[0] == model.score("")[0] < 0.5
    assert 0 <= toxicity.train([], []).score("x")[0] < 0.5


# 6 language model


def test_counts_and_probabilities(spark):
    texts = [prose(60, i) for i in range(40)] + [None, "", "UNSEEN words here"]
    rows = lm_scoring.language_model_scores(table(spark, texts), block_chars=2_000).collect()
    learned = [t for i, t in enumerate(texts, 1) if _crc(i) % 10]
    counts = Counter(w for t in learned for w in lm_scoring.tokens_of(t))
    total = sum(counts.values())
    assert len(rows) == len(texts)
    for r in rows:
        tokens = lm_scoring.tokens_of(texts[r.doc_id - 1])
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens)
        assert (r.n_tokens, r.train_tokens) == (len(tokens), total)
        assert r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(base) and r.score <= 0
        assert r.held_out == (_crc(r.doc_id) % 10 == 0)
    assert lm_scoring.language_model_scores(table(spark, texts).limit(0)).count() == 0


def _crc(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode())


def test_packed_numbers_return():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 500, dtype=np.uint64))
    assert (lm_scoring._unpacked(lm_scoring._packed(keys)) == keys).all()
    counts = np.arange(500) ** 3
    assert (lm_scoring._counts(lm_scoring._small(counts)) == counts).all()


# 7 language


def test_language(spark):
    spell = {"aa": "abcde", "zz": "vwxyz"}
    texts, labels = [], []
    for i in range(120):
        label = ("aa", "zz")[i % 2]
        texts.append(" ".join("".join(random.Random(i * 50 + k).choices(spell[label], k=5)) for k in range(30)))
        labels.append(label)
    network = language_id.train(texts, labels, epochs=4)
    found, scores = network.predict(["abc dab cab", "zyx wvx", None, "", "12 !", texts[0] * 40])
    assert found == ["aa", "zz", "und", "und", "und", "aa"]
    assert list(scores[2:5]) == [0, 0, 0] and all(0.5 < s <= 1 for s in scores[[0, 1, 5]])
    nothing = language_id.fit(table(spark, ["abc"]).limit(0))
    assert nothing.predict(["abc", None])[0] == ["und", "und"]


# 8 exact dedup


def test_exact_duplicates(spark, odd):
    got = exact_duplicates(odd, salts=3).collect()
    by_text = {}
    for r in odd.collect():
        by_text.setdefault(r.text or "", []).append(r.doc_id)
    expected = Counter()
    for text, ids in by_text.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == expected
    assert exact_duplicates(odd.limit(0)).count() == 0


# 9 PII


def luhn(digits):
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def test_pseudonyms(spark):
    text = (
        "Card 4539578763621486, not 4539578763621487. Host 10.0.0.1, not 999.1.1.1. Call +1 (017) 555-7713! "
        "Mail joe.26@mail6.example.com; on 2024-01-15, 15.01.2024, 01/15/2024, not 2024-02-31. x4539578763621486"
    )
    docs = table(spark, [text, "Again 4539578763621486!!", None, "", "no digits", "4539-5787-6362-1486"])
    rows = {r.doc_id: r for r in pii.pseudonymised(docs, "k").collect()}
    found = {f.value: f for f in rows[1].found}
    assert sorted(f.kind for f in rows[1].found) == ["card", "date", "date", "date", "email", "ip", "phone"]
    card = found["4539578763621486"].pseudonym
    assert card != "4539578763621486" and len(card) == 16 and luhn(card)
    assert rows[2].text == f"Again {card}!!"  # equal values stay linked
    assert re.sub("-", "", rows[6].text) == card and re.fullmatch(r"\d{4}(-\d{4}){3}", rows[6].text)
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", found["+1 (017) 555-7713"].pseudonym)
    assert re.fullmatch(r"[a-z]{3}\.\d\d@mail6\.example\.com", found["joe.26@mail6.example.com"].pseudonym)
    year, month, day = found["2024-01-15"].pseudonym.split("-")
    assert found["15.01.2024"].pseudonym == f"{day}.{month}.{year}"
    assert found["01/15/2024"].pseudonym == f"{month}/{day}/{year}"
    expected = text
    for f in rows[1].found:
        expected = re.sub(r"(?<![\w.+])" + re.escape(f.value), f.pseudonym, expected)
    assert rows[1].text == expected
    assert [rows[i].text for i in (3, 4, 5)] == [None, "", "no digits"]


def test_values_without_digits_around_or_before_a_time(spark):
    docs = table(
        spark,
        ["Write to john.smith@example.com", "John.Smith@example.com, room 7", "at 2024-01-15T10:00:00Z.",
         "on 2024-01-15", "2024-01-15Tea", "q@example.com", "mail aaaa@example.com", "mail bbbb@example.com"],
    )
    got = {r.doc_id: r for r in pii.pseudonymised(docs, "k").collect()}
    address = got[1].text.removeprefix("Write to ")
    assert re.fullmatch(r"[a-z]{4}\.[a-z]{5}@example\.com", address) and address != "john.smith@example.com"
    assert got[2].text.lower() == f"{address}, room 7" and re.match("[A-Z][a-z]+[.][A-Z][a-z]+@", got[2].text)
    assert got[3].text == f"at {got[4].text.removeprefix('on ')}T10:00:00Z." != "at 2024-01-15T10:00:00Z."
    assert got[5].text == "2024-01-15Tea" and re.fullmatch("[a-z]@example.com", got[6].text)
    shifts = [[(ord(y) - ord(x)) % 26 for x, y in zip(w, got[i].text[5:])] for i, w in ((7, "aaaa"), (8, "bbbb"))]
    assert shifts[0] != shifts[1] and max(len(set(s)) for s in shifts) > 1  # no shift of the alphabet


def test_letters_are_a_permutation(spark):
    pairs = ["".join(p) for p in itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=2)]
    made = pii.pseudonymised(table(spark, [f"{p}@example.com" for p in pairs]), "k")
    assert made.select("text").distinct().count() == len(pairs)


def test_pseudonyms_are_a_permutation(spark):
    values = spark.range(256).select(F.concat(F.lit("10.0.0."), "id").alias("text"), F.col("id").alias("doc_id"))
    assert pii.pseudonymised(values, "k").select("text").distinct().count() == 256
    days = spark.range(400).select(
        F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text")
    )
    made = pii.pseudonymised(days, "k")
    assert made.select("text").distinct().count() == 400
    assert made.where(~F.year(F.col("text").cast("date")).between(1900, 2099)).count() == 0
    with pytest.raises(ValueError):
        pii.pseudonymised(days, "")


# 10 HTML


def test_main_text():
    body = "".join(f"<p>{html.escape(prose(40, i))} &amp; <a href=x>{prose(3, i)}</a>\n more</p>" for i in range(4))
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=a>menu</a></ul></nav>"
        "<div class='cookie-notice'>notice</div><header>site</header><div id=sidebar>side</div>"
        f"<div class=content><h1>Title</h1>{body}</div><form>form</form><div class=comments><p>{prose(30, 9)}</p></div>"
        "<script>var t='<p>no</p>'</script><footer>foot</footer></body></html>"
    )
    lines = [f"{prose(40, i)} & {prose(3, i)} more" for i in range(4)]
    assert html_text.main_text(page).split("\n") == ["Title", *lines]
    assert html_text.main_text(page.replace("<div class=content>", "<article>").replace("</div><form", "</article><form")).split("\n") == ["Title", *lines]
    assert [html_text.main_text(p) for p in (None, "", "<p>", "a &lt; b")] == ["", "", "", "a < b"]
    assert html_text.main_text("<div>" * 5000 + "deep") == "deep"


def test_main_text_in_sibling_containers():
    def part(first, last):
        return "".join(f"<p>{prose(40, i)}</p>" for i in range(first, last))

    links = "".join(f"<li><a href=x>{prose(2, i)}</a></li>" for i in range(12))
    page = (
        f"<html><body><ul>{links}</ul><div class=part1>{part(0, 10)}</div><div><a href=x>more</a></div>"
        f"<div class=part2>{part(10, 13)}</div><ul>{links}</ul></body></html>"
    )
    assert html_text.main_text(page).split("\n") == [prose(40, i) for i in range(13)]


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>t</title></head><body><form action=x><input name=a>{}<button>Send</button></form></body></html>",
        "<form><article>{}</article><select><option>a</option></select></form>",
        "<div class='layout has-sidebar'>{}<div class=sidebar>side</div></div>",
        "<div class='no-sidebar'>{}</div>",
        "<div class='page-widget'><main>{}</main></div>",
        "<head><title>t</title><body>{}</body>",
        "<head><title>t</title><meta charset=utf-8><div>{}</div>",
        "<article><div class='article-header'><h1>Title</h1></div>{}</article>",
    ],
)
def test_main_text_is_not_cut_away(page):
    body = [prose(40, i) for i in range(4)]
    heading = ["Title"] if "Title" in page else []
    got = html_text.main_text(page.format("".join(f"<p>{t}</p>" for t in body)))
    assert got.split("\n") == [*heading, *body]


def test_comments_and_small_forms_stay_away():
    body = "".join(f"<p>{prose(40, i)}</p>" for i in range(4))
    side = f"<form><p>{prose(20, 7)}</p></form><div class=comments><article>{prose(30, 8)}</article></div>"
    got = html_text.main_text(f"<article>{body}</article>{side}")
    assert got.split("\n") == [prose(40, i) for i in range(4)]


# pipeline


def test_pipeline(spark, odd, tmp_path):
    bench = spark.createDataFrame([(0, prose(30, 60))], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    more = table(spark, [f"{prose(80, 70)} {prose(30, 60)}"] + [prose(120, 80 + i) for i in range(20)], 100)
    odd.union(more).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not got & {1, 2, 3, 4, 9, 100}  # no letters; a copy; contaminated
    assert got >= {8, *range(101, 121)}
    odd.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    bench.write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
