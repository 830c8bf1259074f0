"""Operators against brute force, exact round trips, held-out accuracy, and
odd inputs: nulls, empty and long texts, repeated rows, empty tables, extra
columns with the names of results."""

import base64
import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from webloom.llm import (bpe, chat, decontaminate, exact, fuzzy_lines, html_text, jaccard_join, queries, sharding, toxicity, warc)
from webloom.llm.hashing import shingles

SF = "/root/testdata/sf0.001"
RNG = random.Random(4)
WORDS = ["".join(RNG.choice("abcdefghé") for _ in range(RNG.randint(2, 9))) for _ in range(400)]


def prose(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


def odd_docs():
    base = prose(60)
    w = base.split()
    rows = [(i, prose(RNG.randint(1, 80)) + "\n" + prose(30)) for i in range(20)]
    rows += [(100, base), (101, base), (102, base.upper()), (103, " ".join(w[:-1] + ["new"])), (104, " ".join(w + ["tail"])),
             (105, None), (106, ""), (None, base), (None, "one line"), (107, "two words"), (107, "other text of the same id"),
             (108, "rep eat ed\nrep eat ed\n\n  rep eat ed\t"), (108, "rep eat ed\nrep eat ed\n\n  rep eat ed\t"),
             (109, "x" * 30_000), (110, prose(9_000)), (111, "\n\n"), (112, base + "\n" + prose(12))]
    return rows


ROWS = odd_docs()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    # extra columns, some with the names of results
    return df.withColumn("n_lines", F.lit("x")).withColumn("ids", F.lit(1)).withColumn("shard", F.lit("s")).withColumn(
        "n_tokens", F.lit(None).cast("string")).withColumn("n_chars", F.length("text")).withColumn("score", F.lit("a")).repartition(3)


def empty(docs):
    return docs.where("doc_id = -5")


def test_bpe_equals_the_public_library_and_round_trips(spark, docs):
    v = bpe.load_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.value.ranks, special_tokens={})
    out = bpe.decode(bpe.encode(docs, v), v).collect()
    want = collections.Counter((i, b"".join(x.to_bytes(4, "little") for x in lib.encode_ordinary(t or "")), (t or "").encode())
                               for i, t in ROWS)
    assert collections.Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in out) == want
    assert bpe.encode(empty(docs), v).count() == 0
    encoder, alphabet = bpe.Encoder(v.value), "abcthe 'sré\n\t\x1c\x85 日本語١²½😀_-.,!?0123"
    for _ in range(500):
        t = "".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 40)))
        assert encoder.encode_batch([t])[0] == b"".join(x.to_bytes(4, "little") for x in lib.encode_ordinary(t))


def test_chat_windows_read_back(spark):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 0, None, None),
            (2, None, "user", "a\\b <s>"), (2, 0, "assistant", "\\<s>"), (None, 0, "user", "n"), (3, 0, "user", "same"),
            (3, 0, "user", "same")]
    rows += [(9, i, "system" if i == 0 else ("user", "assistant")[i % 2], prose(RNG.randint(1, 40))) for i in range(900)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("window", F.lit(0))
    windows = chat.chat_windows(df, budget=120, history=30, segment=4)
    got = {r.conv_id: r for r in chat.chat_digests(windows).collect()}
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is None, t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(turns), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    long = windows.where("conv_id = 9").collect()
    assert len(long) > 50 and len({r.segment for r in long}) > 10
    tokens = lambda t: len(re.findall(r"\w+|[^\w\s]", t)) + chat.OVERHEAD
    system = next(t for c, i, r, t in rows if (c, i) == (9, 0))
    for r in long:
        turns = chat.parse(r.formatted)
        assert sum(tokens(t) for _, t in turns) <= 120 or r.n_turns == 1
        assert turns[0] == ("system", system) and len(turns) == r.n_repeated + r.n_turns
    assert any(r.n_repeated > 1 for r in long if r.segment > 0 and r.window == 0)
    assert chat.chat_digests(chat.chat_windows(df.where("conv_id = 77"))).count() == 0


def brute_contamination(rows, items):
    word = re.compile(decontaminate.WORD)
    table = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)
    split = lambda t: word.findall((t or "").translate(table))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add("null" if item is None else str(item))
    out = []
    for d, text in rows:
        w, hit, found = split(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit)))
    return collections.Counter(out)


@pytest.mark.parametrize("bound", [10**6, 0])
def test_decontamination_equals_brute_force(spark, docs, bound):
    w = ROWS[20][1].split()
    items = [(1, " ".join(w[5:17])), (2, " ".join(w[5:17])), (3, prose(20)), (4, "TWO words"), (5, None), (6, "..."), (None, " ".join(w[40:50])),
             (7, WORDS[0]), (8, "rep eat ed rep"), (3, " ".join(w[30:41])), (9, "a a a a a a a a a a a a a a")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("size", F.lit(1))
    got = decontaminate.contamination(docs, benchmark, bound).drop("dkey").collect()
    assert collections.Counter(map(tuple, got)) == brute_contamination(ROWS, items)
    none = decontaminate.contamination(docs, benchmark.where("item_id = 99"), bound)
    assert none.where("contaminated").count() == 0 and none.count() == len(ROWS)
    assert decontaminate.contamination(empty(docs), benchmark, bound).count() == 0


def test_toxicity_is_learned_and_holds_out(spark):
    bad = ["grobnik", "sluzzard", "vermix"]
    rows, labels = [], []
    for i in range(900):
        words = prose(RNG.randint(20, 60)).split()
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words.insert(RNG.randrange(len(words)), RNG.choice(bad) + RNG.choice(["", "s", "ly"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    lexicon = toxicity.train(df, lab, support=5)
    extra = [(-1, None), (-2, ""), (-3, "you GR0BNIK, you vеrm1x!"), (-4, "fine " * 30_000)]
    scored = toxicity.score(df.union(spark.createDataFrame(extra, "doc_id bigint, text string")).withColumn("score", F.lit("old")), lexicon)
    got = {r.doc_id: (r.score, r.h) for r in scored.withColumn("h", toxicity.held_out()).collect()}
    held = [(got[i][0] >= toxicity.CUT, y) for i, y in labels if got[i][1]]
    assert len(held) > 150 and sum(p == bool(y) for p, y in held) / len(held) > 0.98
    assert got[-3][0] > 0.5 and max(got[-1][0], got[-2][0], got[-4][0]) < toxicity.CUT
    assert toxicity.train(df, lab.where("doc_id < 0")).terms == {}
    m = toxicity.Lexicon({"grob": 2.0}, frozenset({"grobfish tank"}), (0.0, 1.0, 1.0)).matcher()
    assert m.features("a grobfish tank") == (0.0, 0.0) and m.features("a grobfish bowl")[0] > 0 and m.features("xgrob") == (0.0, 0.0)


def test_toxicity_trains_on_one_row_of_a_doc_id(spark):
    rows = [(i, f"text {i}") for i in range(40)] + [(0, "text 0")] * 50 + [(1, f"other text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    lab = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    got = [tuple(r) for r in toxicity.training_rows(df, lab, 12_000).collect()]
    known = {r[0] for r in lab.where(~toxicity.held_out()).select("doc_id").collect()}
    assert {0, 1} & known and sorted(x[0] for x in got) == sorted(known)
    assert all((d, t) in rows and y == d % 2 for d, t, y in got)
    assert sorted(got) == sorted(map(tuple, toxicity.training_rows(df.repartition(5), lab, 12_000).collect()))


def test_shards_are_even_and_gapless(docs):
    for n, size in ((24, 4096), (3, 1 << 20), (7, 1)):
        got = sharding.shard(docs, n, bucket_bytes=size).collect()
        assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(ROWS)
        slots = collections.defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
            assert r["size"] == len((r.text or "").encode()) + 8
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert {len(ROWS) // n, -(-len(ROWS) // n)} >= {len(s) for s in slots.values()}
        again = sharding.shard(docs.repartition(5), n, bucket_bytes=size).collect()
        key = lambda rs: sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in rs)
        assert key(got) == key(again)
    assert sharding.shard(empty(docs), 4).count() == 0


def test_shards_are_written_and_read_back(spark, docs, tmp_path, monkeypatch):
    sharded = sharding.shard(docs, 3, bucket_bytes=4096)
    path = str(tmp_path / "shards")
    sharding.write_shards(sharded, path)
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} == {f"shard={i}" for i in range(3)}
    back = sharding.read_shards(spark, path, sharded.schema)
    assert back.schema.names == sharded.schema.names
    assert collections.Counter(map(tuple, back.collect())) == collections.Counter(map(tuple, sharded.collect()))
    for file in (tmp_path / "shards").rglob("*.parquet"):
        slots = [r.slot for r in spark.read.parquet(str(file)).select("slot").coalesce(1).collect()]
        assert slots == sorted(slots)
    none = sharding.shard(empty(docs), 3)
    sharding.write_shards(none, str(tmp_path / "none"))
    assert sharding.read_shards(spark, str(tmp_path / "none"), none.schema).count() == 0
    written = []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda df, to: (written.append(to), write(df, to)))
    got = queries.op5_shards(spark, SF)
    assert got.inputFiles() and all(f"/{written[0].rpartition('/')[2]}/shard=" in f for f in got.inputFiles())
    want = sharding.shard(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), 24).drop("text")
    assert got.columns == want.columns
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(map(tuple, want.collect()))


def test_warc_round_trip_with_segments(spark, tmp_path):
    long = "é WARC/1.1\r\n\r\n0\r\n\r\n" * 3000
    rows = [(1, "http://a/ é\r\n", "short"), (2, None, "short"), (3, "u", long), (4, "u", long), (4, "u", long), (5, "v", None),
            (None, "w", prose(400)), (7, "x", ""), (8, "y", "z" * 999), (9, "y", "z" * 999), (10, "y", "q" * 1000), (11, "y", "q" * 1000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1)).repartition(2)
    path = str(tmp_path / "warc")
    warc.write_warc(pages, path, segment_bytes=700, chunk_bytes=300, records_per_file=40)
    whole = warc.read_warc(spark, path).cache()
    assert whole.where("not complete").count() == 0
    response = {r.page_id: bytes(r.payload).decode() for r in whole.where("record_type = 'response'").collect()}
    assert response == {i: (h or "") for i, _, h in rows if i not in (3, 10)}
    assert {r.url for r in whole.collect()} == {u for _, u, _ in rows}
    got = sorted(map(str, warc.page_records(whole).collect()))
    keep = {long: 4, "q" * 1000: 11}
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = keep.get(h, i) != i
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", keep[h] if revisit else None, True))
    assert got == sorted(f"Row(page_id={a}, payload_bytes={b}, payload_digest={c!r}, record_type={d!r}, refers_to={e}, complete={f})"
                         for a, b, c, d, e, f in want)
    records = warc.read_records(spark, path)
    lost = warc.reassemble(records.where("coalesce(segment, 1) <> 2"))
    assert lost.where("not complete").count() > 0
    empty_path = str(tmp_path / "none")
    warc.write_warc(pages.where("page_id = 99"), empty_path)
    assert warc.unchunked(warc.chunked(b"", 5)) == b""


def components_of(n, linked):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        parent[find(max(i, j))] = find(min(i, j))
    return [find(i) for i in range(n)]


def test_similar_documents_equal_brute_force(spark, docs):
    sets = [set(shingles((t or "").encode(), 5).tolist()) for _, t in ROWS]
    linked = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and a and b and len(a & b) >= 0.8 * len(a | b)]
    roots = components_of(len(ROWS), linked)
    links = collections.Counter(x for p in linked for x in p)
    low = {}
    for (d, _), r in zip(ROWS, roots, strict=True):
        low[r] = min(low.get(r, 1 << 60), 1 << 60 if d is None else d)
    want = collections.Counter((d, t and hashlib.md5(t.encode()).hexdigest(), links[i], (None if low[r] == 1 << 60 else low[r]) if sets[i] else d)
                               for i, ((d, t), r) in enumerate(zip(ROWS, roots, strict=True)))
    out = jaccard_join.similar_documents(docs)
    joined = docs.select("text", F.unhex(F.md5("text")).alias("_"), decontaminate.row_key().alias("dkey")).dropDuplicates(["dkey"]).join(out, "dkey")
    got = collections.Counter((r.doc_id, r.text and hashlib.md5(r.text.encode()).hexdigest(), r.n_links, r.class_id) for r in joined.collect())
    assert got == want
    assert jaccard_join.similar_documents(empty(docs)).count() == 0


def test_similar_documents_find_all_links_of_a_dense_group(spark):
    """A group of near copies larger than a bucket and a block, beside clean rows."""
    base = prose(120).split()
    rows = [(i, " ".join([*base[:k], f"edit{i}", *base[k + 1:]])) for i, k in ((i, 10 + i % 100) for i in range(600))]
    rows += [(1000 + i, prose(50)) for i in range(200)]
    out = jaccard_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    sets = [set(shingles(t.encode(), 5).tolist()) for _, t in rows]
    want = {d: sum(i != j and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)) for i, ((d, _), a) in enumerate(zip(rows, sets, strict=True))}
    assert {r.doc_id: r.n_links for r in out} == want
    assert all(r.class_id == (0 if r.doc_id < 600 else r.doc_id) for r in out) and sum(r.kept for r in out) == 201


def test_fuzzy_lines_equal_brute_force(spark, docs):
    key = {}
    for d, t in ROWS:
        key[d, t] = hashlib.md5(((str(d) if d is not None else "null") + ("\0n" if t is None else "\0t") + (t or "")).encode()).digest()
    first = {}
    for d, t in ROWS:
        for j, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\r"):
                at = (d is None, d or 0, key[d, t], j)
                first[line.strip(" \t\r")] = min(at, first.get(line.strip(" \t\r"), at))
    lines = list(first)
    sets = [{x[i:i + 5] for i in range(max(1, len(x) - 4))} for x in lines]  # the operator's own k
    roots = components_of(len(lines), [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j and len(a & b) >= 0.8 * len(a | b)])
    keep = {}
    for line, r in zip(lines, roots, strict=True):
        keep[r] = min(keep.get(r, first[line]), first[line])
    root = dict(zip(lines, roots, strict=True))
    want = collections.Counter()
    for d, t in ROWS:
        kept = [x for j, x in enumerate((t or "").split("\n"))
                if not x.strip(" \t\r") or keep[root[x.strip(" \t\r")]] == (d is None, d or 0, key[d, t], j)]
        want[d, None if t is None else "\n".join(kept)] += 1
    out = fuzzy_lines.dedup_lines(docs)
    assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert set(docs.columns) | {"n_dropped"} == set(out.columns)
    assert fuzzy_lines.dedup_lines(empty(docs)).count() == 0


def test_fuzzy_lines_drop_short_lines_with_one_edit(spark):
    """One changed character inside lines of 50 to 95 characters, one in each of 60 documents."""
    lines = []
    while len(lines) < 60:
        line = prose(RNG.randint(9, 16))
        if 50 <= len(line) <= 95 and len({line[i:i + 5] for i in range(len(line) - 4)}) == len(line) - 4:
            lines.append(line)
    cut = [RNG.randint(10, len(x) - 10) for x in lines]
    edited = [x[:c] + "#" + x[c + 1:] for x, c in zip(lines, cut, strict=True)]
    rows = list(enumerate(lines)) + [(100 + i, x) for i, x in enumerate(edited)]
    out = {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert all(out[i] == x for i, x in enumerate(lines))
    # the bands meet a pair at 0.8 with 0.998
    assert sum(out[100 + i] == "" for i in range(60)) >= 58


def test_fuzzy_lines_link_families_across_rounds(spark):
    """Families of lines with an edit each, chained by a line between two of
    them, one as large as several blocks; unrelated lines stay."""
    def edited(line, c):
        return line[:c] + "#" + line[c + 1:]

    bases = [prose(40) for _ in range(6)]
    lines = [edited(b, 5 + 7 * i % (len(b) - 10)) for b in bases for i in range(8)]
    lines += [edited(bases[0], 3 + i % 200) + f" {i % 7}" for i in range(700)] + [prose(30) for _ in range(100)]
    rows = [(i, x) for i, x in enumerate(dict.fromkeys(lines))]
    sets = [{x[i:i + 5] for i in range(len(x) - 4)} for _, x in rows]
    like = [(i, j, len(a & b) / len(a | b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j]
    roots = components_of(len(rows), [(i, j) for i, j, s in like if s >= 0.8])
    assert components_of(len(rows), [(i, j) for i, j, s in like if s >= 0.85]) == roots  # no component hangs on a rare band
    out = {r.doc_id: r.text for r in fuzzy_lines.dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert {d for d, t in out.items() if t} == {r for r in roots}


@pytest.mark.parametrize("m", [2, 5, 8, 9, 60])
def test_local_components_equal_union_find(m):
    """Chains, dense groups and loners; only wanted pairs may be relied on."""
    for near in (0.05, 0.5, 0.95):
        base = [RNG.sample(range(1000 * g, 1000 * g + 60), 40) for g in range(3)]
        sets = []
        for _ in range(m):
            own = list(RNG.choice(base)) if RNG.random() < near else RNG.sample(range(9000, 9999), RNG.randint(1, 40))
            sets.append(np.unique(np.array(own[RNG.randint(0, 6):] + [RNG.randint(5000, 5003)], dtype=np.uint64)))
        pairs = [(i, j) for i in range(m) for j in range(i + 1, m) if RNG.random() < 0.8]
        linked = [(i, j) for i, j in pairs if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
        matrix = np.zeros((m, m), dtype=bool)
        for i, j in pairs:
            matrix[i, j] = True
        roots = components_of(m, linked)
        want = [roots.index(r) for r in roots]  # the smallest member of each component
        assert fuzzy_lines.local_components(sets, matrix, 0.8) == want
        assert fuzzy_lines._few_components(sets, pairs, 0.8) == want


@pytest.mark.parametrize("id_bytes", [16, 1])
def test_exact_groups_equal_brute_force(docs, id_bytes):
    lower = lambda t: (t or "").encode().lower()
    group = collections.defaultdict(list)
    for d, t in ROWS:
        group[lower(t)].append(d)
    want = collections.Counter()
    for d, t in ROWS:
        g = group[lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        want[d, keep, len(g), d == keep, hashlib.sha256(lower(t)).hexdigest()] += 1
    assert collections.Counter(map(tuple, exact.exact_groups(docs, id_bytes=id_bytes).collect())) == want
    assert exact.exact_groups(empty(docs)).count() == 0


def test_chunks_cover_the_text_and_shift_with_it():
    data = prose(20_000).encode()
    assert b"".join(exact.chunks(data)) == data and max(map(len, exact.chunks(data))) <= exact.MAX_CHUNK
    a, b = set(exact.chunks(data)), set(exact.chunks(b"inserted " + data))
    assert len(a & b) > 0.8 * len(a)


def test_html_main_text(spark):
    article = "<p>One &amp; two<br>three</p><div>Four <a href=x>five</a>\n six</div>tail"
    page = ("<html><head><title>T</title><style>x{}</style></head><body><nav><ul><li><a>Menu</a></ul></nav><header>Top</header>"
            f"<div class='cookie-notice'>Accept</div><article><header><h1>Head</h1></header>{article}<aside>Side</aside><form>Go<input></form>"
            "<section class='comments'><p>Reader says</p></section><script>if (a<b) '</p>'</script><footer>By</footer></article>"
            "<div id=sidebar>Bar</div><footer>Foot</footer></body>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p>" + "word " * 40), (5, "u", "<b>" * 50_000 + "deep text of the page"),
            (6, "u", "<a x=1 " * 5_000), (1, "u", page), (None, "u", "a < b &lt; c and more words here to read")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("old"))
    got = [(r.page_id, r.text, r.n_chars) for r in html_text.extract(df).collect()]
    main = "Head One & two three Four five six tail"
    assert got.count((1, main, len(main))) == 2 and (2, "", 0) in got and (3, "", 0) in got and (6, "", 0) in got
    assert (5, "deep text of the page", 21) in got and (4, ("word " * 40).strip(), 199) in got
    assert (None, "a < b < c and more words here to read", 37) in got
    tree = html_text.train_tree(html_text.LABELLED)
    assert all(html_text.classify(tree, r[:-1]) == r[-1] for r in html_text.LABELLED)


def test_pipeline_stages_keep_clean_documents(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.join(docs, "doc_id", "left_anti").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_copies", "decontamination", "bpe"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    clean = {x[0] for x in brute_contamination(rows, items) if not x[-1]}
    assert {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, SF).collect()} == clean
    vocabulary = {base64.b64decode(a) for a, _ in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    assert len(vocabulary) == 50_256
    assert corpus_pipeline.tokenize(spark, docs, SF).count() == docs.count()


def test_pipeline_drops_copies_and_emptied_documents(spark):
    import corpus_pipeline
    rows = [(i, prose(60) + "\n" + prose(60)) for i in range(30)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(rows[:5])]                             # copies
    rows += [(200 + i, t.replace(t.split()[30], "edited", 1)) for i, (_, t) in enumerate(rows[5:10])]  # near copies
    rows += [(300, ""), (301, None), (302, rows[0][1] + "\n" + prose(50))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang", F.lit("en")).withColumn("n_chars", F.lit(1))
    out = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, df, SF).collect()}
    assert set(out) == {*range(30), 300, 301, 302}
    assert out[302] and out[302] in rows[-1][1] and out[300] == "" and out[301] is None
    kept = corpus_pipeline.drop_near_copies(spark, df, SF).collect()
    assert {r.doc_id for r in kept} >= {300, 301, 302} and sum(r.doc_id < 300 for r in kept) == 30


def test_pipeline_decodes_its_ids(spark, docs):
    import corpus_pipeline
    got = corpus_pipeline.tokenize(spark, docs, SF).collect()
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in got) == collections.Counter(
        (i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS)


def test_pipeline_keeps_one_of_repeated_rows(spark):
    import corpus_pipeline
    base, other = prose(60), prose(60)
    rows = [(1, base)] * 40 + [(2, base)] * 3 + [(3, other)] * 5 + [(4, "")] * 2 + [(5, prose(50))] + [(6, None)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, df, SF).collect()]
    assert collections.Counter(got) == collections.Counter([(1, base), (3, other), (4, ""), (4, ""), rows[-3], (6, None), (6, None)])


def test_sieve_keeps_every_line_with_a_near_sketch():
    rng = np.random.default_rng(3)
    import pyarrow as pa
    for across in (False, True):
        base = rng.integers(0, 256, size=(4, fuzzy_lines.SKETCH), dtype=np.uint8)
        rows = np.concatenate([base, base, rng.integers(0, 256, size=(30, fuzzy_lines.SKETCH), dtype=np.uint8)])
        for i in range(4):  # agree in just enough, or in one too few, of the values
            rows[4 + i, :fuzzy_lines.SKETCH - fuzzy_lines.LEAST + i % 2] += np.uint8(1)
        block = rng.integers(0, 2, size=len(rows)).astype(np.int32)
        group = pa.table({"band": pa.array([7] * len(rows), pa.int64()), "block_a": pa.array([0] * len(rows), pa.int32()),
                          "block_b": pa.array([int(across)] * len(rows), pa.int32()), "block": block,
                          "lid": pa.array([bytes([i]) for i in range(len(rows))], pa.binary()),
                          "sketch": pa.array([r.tobytes() for r in rows], pa.binary())})
        got = {x[0] for t in fuzzy_lines._sieved([group]) for x in (v.as_py() for v in t.column("lid"))}
        want = {i for i in range(len(rows)) for j in range(len(rows)) if i != j and (rows[i] == rows[j]).sum() >= fuzzy_lines.LEAST
                and (not across or block[i] != block[j])}
        assert got == want and (across or len(want) == 4)


def test_buckets_are_sieved_and_named_by_their_members_where_they_are_found():
    """Of the buckets of a hash range only members with a partner become rows,
    buckets of equal members are one, large buckets keep all members for their blocks."""
    import pyarrow as pa
    far = np.uint64((1 << (fuzzy_lines.SKETCH - fuzzy_lines.LEAST + 1)) - 1)  # a bit more than may differ
    near = far >> np.uint64(1)
    keys = np.array([1, 1, 1, 2, 2, 3, 4, 4, 5, 5, 5], dtype=np.uint32)
    lines = np.array([10, 11, 12, 11, 10, 13, 14, 15, 16, 16, 17], dtype=np.uint64)  # line 16 from two tasks
    sketches = np.array([0, near, ~np.uint64(0), near, 0, 0, 0, far, 7, 7, 7], dtype=np.uint64)
    m = fuzzy_lines.BLOCK + 1
    keys = np.concatenate([keys, np.full(m, 9, dtype=np.uint32)])
    lines = np.concatenate([lines, np.arange(100, 100 + m, dtype=np.uint64)])
    sketches = np.concatenate([sketches, np.where(np.arange(m) % 2, ~np.uint64(0), np.uint64(0))])
    order = np.random.default_rng(1).permutation(len(keys))
    cut = [order[:100], order[100:]]
    group = pa.table({"part": [0, 0], **{name: pa.array([x[i].tobytes() for i in cut], pa.binary())
                                         for name, x in (("keys", keys), ("lines", lines), ("sketches", sketches))}})
    rows = {tuple(r.values()) for b in fuzzy_lines._shared_bands([group]) for r in b.to_pylist()}
    buckets = collections.defaultdict(set)
    for band, h, _, large in rows:
        buckets[band, large].add(h)
    assert sorted((large, sorted(x)) for (_, large), x in buckets.items()) == [
        (False, [10, 11]), (False, [16, 17]), (True, list(range(100, 100 + m)))]
    assert {(h, s) for _, h, s, large in rows if large} == {(100 + i, -(i % 2)) for i in range(m)}


def test_line_shingles_hash_like_spans():
    from webloom.llm.hashing import prefix, spans
    rng = random.Random(8)
    for k in (1, 2, 5):
        lines = ["".join(rng.choice("ab\u00e9\U0001F600 ") for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 40, 4, 9, 1, 1)]
        hashes, at = fuzzy_lines.shingle_hashes(lines, k)
        for i, line in enumerate(lines):
            data = np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32)
            start = np.arange(max(1, len(line) - k + 1))
            assert hashes[at[i]:at[i + 1]].tolist() == spans(prefix(data), start, np.minimum(start + k, len(line))).tolist()


@pytest.mark.parametrize("chars", [100, 3000, 1 << 17])
def test_groups_compared_at_once_equal_brute_force(monkeypatch, chars):
    """Groups of 1 to 20 lines, cut over batches; a pair that shares a lower band is left to that band."""
    import pyarrow as pa
    monkeypatch.setattr(fuzzy_lines, "CHARS", chars)
    rng = random.Random(chars)
    rows, want = [], set()
    for band in range(80):
        base, first = [rng.choice("abcdefgh ") for _ in range(rng.randint(4, 150))], len(rows)
        for i in range(rng.choice([1, 2, 2, 3, 5, 8, 9, 20])):
            line = list(base)
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice("xyz")
            rows.append((band, f"{''.join(line)}{len(rows):04}", sorted({band, *rng.sample(range(-9, 3), rng.randint(0, 3))})))
        own = rows[first:]
        sets = [{x[i:i + 5] for i in range(len(x) - 4)} for _, x, _ in own]
        pairs = [(i, j) for i in range(len(own)) for j in range(i + 1, len(own)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
                 and not any(b < band for b in set(own[i][2]) & set(own[j][2]))]
        roots = components_of(len(own), pairs)
        want |= {(fuzzy_lines.line_id(own[i][1]), fuzzy_lines.line_id(own[roots.index(r)][1])) for i, r in enumerate(roots) if roots.index(r) != i}
    zero = pa.array([0] * len(rows), pa.int32())
    table = pa.table({"band": pa.array([r[0] for r in rows], pa.int64()), "block_a": zero, "block_b": zero, "block": zero,
                      "line": [r[1] for r in rows], "shared": pa.array([r[2] for r in rows], pa.list_(pa.int64()))})
    got = [x for o in fuzzy_lines._compare(table.to_batches(max_chunksize=7), 5, 0.8)
           for x in zip(o.column(0).to_pylist(), o.column(1).to_pylist(), strict=True)]
    assert len(want) > 50 and set(got) == want and len(got) == len(want)


def test_encoder_remembers_repeated_pieces_only_and_splits_batches(monkeypatch):
    v = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [None, "", *(" ".join(f"xq{i}zj{j}" for j in range(50)) + " again and again" for i in range(60)), "again " * 400]
    whole = bpe.Encoder(v)
    want = whole.encode_batch(texts)
    assert len(want) == len(texts) and " again" in whole.known and len(whole.known) < 600  # of some 3,000 pieces
    monkeypatch.setattr(bpe, "CHARS", 1_000)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 100)
    small, sizes = bpe.Encoder(v), []
    encode = small._encode
    monkeypatch.setattr(small, "_encode", lambda part: sizes.append(sum(len(t or "") for t in part)) or encode(part))
    assert small.encode_batch(texts) == want
    assert len(small.known) <= 100 and max(sizes) <= max(1_000, *(len(t or "") for t in texts))


def test_a_range_of_band_keys_takes_little_memory():
    import tracemalloc

    import pyarrow as pa
    rng, n = np.random.default_rng(5), fuzzy_lines.RANGE_KEYS
    columns = {"keys": rng.integers(0, 1 << 32, n, dtype=np.uint32), "lines": rng.integers(0, 1 << 63, n, dtype=np.uint64),
               "sketches": rng.integers(0, 1 << 63, n, dtype=np.uint64)}
    group = pa.table({c: pa.array([x.tobytes() for x in np.array_split(v, 16)], pa.binary()) for c, v in columns.items()})
    tracemalloc.start()
    try:
        list(fuzzy_lines._shared_bands(iter([group])))
        assert tracemalloc.get_traced_memory()[1] < 40_000_000
    finally:
        tracemalloc.stop()


def test_pipeline_tokenizes_with_one_python_worker_a_task(spark, docs):
    import corpus_pipeline
    out = corpus_pipeline.tokenize(spark, docs, SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and out.count() == len(ROWS)
