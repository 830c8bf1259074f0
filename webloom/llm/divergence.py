"""Source divergence audit by chunk factorization.

A text is a sequence of whitespace chunks (runs between ASCII blanks). Tasks
count the chunks of their documents: for each (lang, source, chunk) of a block
of texts its occurrences and documents, dealt by hash of the chunk over parts and
moved as plain arrays. A part has all counts of its chunks: each globally
distinct chunk is tokenized once (again where a part of more than PART_BYTES goes
on) and its terms are merged with all of its counts. A term is a run of letters
A-Z (lower-cased) and characters outside ASCII.

Occurrences of a term are sums over its chunks. Its distinct documents lie
between the sum over sources of the largest chunk's documents and the sum over
all its chunks. Only terms whose bounds enclose ``min_docs`` need the documents
themselves: a second pass lists (lang, term, document) for these, found in the
tasks by a bitmap of fixed size and settled by a join. So whether a term is kept
is exact, and no (document, term) pair of a frequent term moves.

Each lang keeps its terms of at least ``min_docs`` documents; every source of
the lang gives each of them a smoothed probability (in 1/1,000,000,000, exact
integers), and sources are compared with each other (part ``pair``) and with
the lang (part ``term``) by (p - q)^2 / (p + q). Pairs of sources are summed
over blocks of terms and blocks of sources: no task holds all of either.

Rows: a document is a row; rows that repeat count again. Null text, lang and
source count as empty. A group without terms is compared too; a lang without
kept terms gives pairs of value 0 and no terms; a lang of one source no pairs.
An empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import per_group, require, small_enough, stored

SEPARATOR = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
#: Bytes of text whose chunks a task counts at once (a longer text is counted
#: alone), bytes of text for each part, and bytes of a part that are merged at once.
BLOCK_BYTES, TEXT_BYTES, PART_BYTES = 8 << 20, 16 << 20, 32 << 20
#: ASCII characters but letters; those around a chunk do not decide its part.
MARKS = "".join(chr(c) for c in range(128) if not chr(c).isalpha())
#: Bits of the bitmap of terms whose documents are listed; more terms only make it less selective.
BITS = 1 << 24
#: Terms and sources of one comparison block, and cells of a matrix in it.
BLOCK_TERMS, BLOCK_SOURCES, CELLS = 2048, 512, 1 << 20


def _blocks(batches, limit: int, size=lambda b: b.column("text").nbytes):
    """Tables of consecutive batches of about ``limit`` in size."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += size(batch)
        if total >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document, chunk number) of the chunks of each text in order, and the distinct chunks."""
    chunks = pc.ascii_split_whitespace(texts)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(chunks).to_numpy())
    encoded = chunks.flatten().dictionary_encode()
    code, names = encoded.indices.to_numpy(), encoded.dictionary
    blank = pc.index(names, "").as_py()
    if blank >= 0:
        doc, code = doc[code != blank], code[code != blank]
    return doc, code, names


def _chunk_terms(chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(chunk number, term number, times) of the distinct terms of each chunk, and the terms."""
    split = pc.split_pattern_regex(pc.ascii_lower(chunks), SEPARATOR)
    encoded = split.flatten().dictionary_encode()
    chunk = np.repeat(np.arange(len(chunks), dtype=np.int64), pc.list_value_length(split).to_numpy())
    code, names = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    blank = pc.index(names, "").as_py()
    if blank >= 0:
        chunk, code = chunk[code != blank], code[code != blank]
    pair, times = np.unique(chunk * max(1, len(names)) + code, return_counts=True)
    return pair // max(1, len(names)), pair % max(1, len(names)), times, names


def _parts(chunks: pa.Array, parts: int) -> np.ndarray:
    """The part of each chunk: by its hash without case and outer marks, so
    that most chunks of a term meet."""
    core = pc.ascii_trim(pc.ascii_lower(chunks), MARKS).cast(pa.binary()).to_pylist()
    return (np.array([xxhash.xxh3_64_intdigest(c) for c in core], dtype=np.uint64) % np.uint64(parts)).astype(np.int64)


def _counted(batches, parts: int):
    """(part, langs, sources, chunks, rows) of each block of texts: the groups
    and chunks of a part, and its counts as columns of 32-bit integers (number
    of the chunk and of the group in these lists, occurrences, documents)."""
    for table in _blocks(batches, BLOCK_BYTES):
        doc, code, names = _chunks(table["text"].combine_chunks())
        if not len(code):
            continue
        langs, sources = (table[c].combine_chunks().dictionary_encode() for c in ("lang", "source"))
        n_sources = len(sources.dictionary)
        groups, group = np.unique(langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy(),
                                  return_inverse=True)
        part_of = _parts(names, parts)
        by_part = np.argsort(part_of, kind="stable")
        by_part = by_part[np.bincount(code, minlength=len(names))[by_part] > 0]
        place = np.zeros(len(names), dtype=np.int64)
        place[by_part] = np.arange(len(by_part))
        by_group = np.argsort(group, kind="stable")  # documents numbered by group: one sort brings chunk, group, document
        rank = np.empty(len(group), dtype=np.int64)
        rank[by_group] = np.arange(len(group))
        key = place[code] * len(group)
        key += rank[doc]
        key.sort()
        del doc, code
        chunk, met = key // len(group), group[by_group][key % len(group)]
        start = np.flatnonzero(np.concatenate([[True], (chunk[1:] != chunk[:-1]) | (met[1:] != met[:-1])]))
        n = np.diff(np.append(start, len(key)))
        docs = np.add.reduceat(np.concatenate([[True], key[1:] != key[:-1]]), start, dtype=np.int64)
        chunk, met = chunk[start], met[start]
        del key, start
        edges = np.searchsorted(part_of[by_part], np.arange(parts + 1))
        cuts = np.searchsorted(chunk, edges)
        part = np.repeat(np.arange(parts), np.diff(cuts))
        used, met = np.unique(part * len(groups) + met, return_inverse=True)
        bounds = np.searchsorted(used, np.arange(parts + 1) * len(groups))
        some = groups[used % len(groups)]
        rows = np.stack([chunk - edges[part], met - bounds[part], n, docs]).astype(np.int32)
        offsets = pa.array(bounds.astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(parts, dtype=np.int32)),
             pa.ListArray.from_arrays(offsets, langs.dictionary.take(pa.array(some // n_sources))),
             pa.ListArray.from_arrays(offsets, sources.dictionary.take(pa.array(some % n_sources))),
             pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), names.take(pa.array(by_part))),
             pa.array([rows[:, i:j].tobytes() for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary())],
            names=["part", "langs", "sources", "chunks", "rows"]).filter(pa.array(np.diff(cuts) > 0))


def _merged(pieces: list[tuple]) -> pa.RecordBatch:
    """(lang, source, term, n, most, least) of the pieces of a part: each
    distinct chunk is tokenized, its terms are merged with all of its counts."""
    langs, sources, chunks = (pa.concat_arrays([p[i] for p in pieces]).dictionary_encode() for i in range(3))
    rows = [np.frombuffer(p[3], dtype=np.int32).reshape(4, -1) for p in pieces]
    group_at, chunk_at = (np.cumsum([0, *(len(p[i]) for p in pieces[:-1])]) for i in (0, 2))
    n_sources, width = len(sources.dictionary), len(chunks.dictionary)
    groups, group = np.unique(langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy(),
                              return_inverse=True)
    chunk = chunks.indices.to_numpy().astype(np.int64)[np.concatenate([r[0] + at for r, at in zip(rows, chunk_at, strict=True)])]
    group = group[np.concatenate([r[1] + at for r, at in zip(rows, group_at, strict=True)])]
    key, (n, docs) = _summed(group * width + chunk, *(np.concatenate([r[i] for r in rows]).astype(np.int64) for i in (2, 3)))
    group, chunk = key // width, key % width
    of, code, times, names = _chunk_terms(chunks.dictionary)
    first = np.searchsorted(of, np.arange(width + 1))
    many = (first[1:] - first[:-1])[chunk]
    row = np.repeat(np.arange(len(chunk)), many)
    word = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[chunk][row]
    key = group[row] * max(1, len(names)) + code[word]
    n, docs = n[row] * times[word], docs[row]
    key, (n, most), least = _summed(key, n, docs, largest=docs)
    group, term = groups[key // max(1, len(names))], key % max(1, len(names))
    return pa.RecordBatch.from_arrays(
        [langs.dictionary.take(pa.array(group // n_sources)), sources.dictionary.take(pa.array(group % n_sources)),
         names.take(pa.array(term)), *map(pa.array, (n, most, least))], names=["lang", "source", "term", "n", "most", "least"])


def _summed(key: np.ndarray, *values: np.ndarray, largest: np.ndarray | None = None):
    """The distinct keys with the sums of ``values``, and the largest of ``largest``."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    if not len(start):
        return (key, values) if largest is None else (key, values, largest)
    sums = tuple(np.add.reduceat(v[order], start) for v in values)
    return (key[start], sums) if largest is None else (key[start], sums, np.maximum.reduceat(largest[order], start))


def _tokenized(batches):
    """``_merged`` of the pieces of each part, from rows that are sorted by part.
    A part of more than PART_BYTES is merged piece by piece."""
    held, size, last = [], 0, None
    for batch in batches:
        part, rows = batch.column("part").to_pylist(), batch.column("rows")
        lists = [batch.column(c) for c in ("langs", "sources", "chunks")]
        for i, p in enumerate(part):
            if held and (p != last or size >= PART_BYTES):
                yield _merged(held)
                held, size = [], 0
            held.append((*(x[i].values for x in lists), rows[i].as_py()))
            size += len(held[-1][3]) + held[-1][2].nbytes
            last = p
    if held:
        yield _merged(held)


def _listed(batches, bitmap: np.ndarray):
    """(lang, term, id): the documents of the terms that the bitmap has."""
    first = TaskContext.get().partitionId() << 40
    for table in _blocks(batches, BLOCK_BYTES):
        doc, code, names = _chunks(table["text"].combine_chunks())
        chunk, term, _, terms = _chunk_terms(names)
        langs = table["lang"].combine_chunks().dictionary_encode()
        lang_of = langs.indices.to_numpy()
        hashes = np.array([xxhash.xxh64_intdigest(t, 42) for t in terms.cast(pa.binary()).to_pylist()], dtype=np.uint64)
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            bit = ((hashes ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), 42))) & np.uint64(BITS - 1)).astype(np.int64)
            wanted = ((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)[term]
            asked = np.zeros(len(names), dtype=bool)
            asked[chunk[wanted]] = True
            own = np.flatnonzero(asked[code])
            own = own[lang_of[doc[own]] == i]
            order = np.argsort(code[own], kind="stable")
            d, c = doc[own][order], code[own][order]
            lo, hi = np.searchsorted(c, chunk[wanted]), np.searchsorted(c, chunk[wanted], side="right")
            at = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
            pair = np.unique(np.repeat(term[wanted], hi - lo) * np.int64(len(lang_of) + 1) + d[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(pair), pa.string()), terms.take(pa.array(pair // (len(lang_of) + 1))),
                 pa.array(pair % (len(lang_of) + 1) + first)], names=["lang", "term", "id"])
        first += table.num_rows


def _bitmap(terms: DataFrame) -> np.ndarray:
    """BITS bits, set at the hashes of (lang, term): at most BITS / 8 bytes, whatever the number of terms."""
    bit = (F.xxhash64("lang").bitwiseXOR(F.xxhash64("term")).bitwiseAND(F.lit(BITS - 1)) + 1).alias("bit")
    rows = (terms.select(bit).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(bytes(r.bits), dtype=np.uint8)
        out[(r.bucket - 1) * 4096:(r.bucket - 1) * 4096 + len(part)] = part
    return out


def term_counts(docs: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n) with the occurrences of the kept terms, and the kept (lang, term)."""
    texts = docs.select("lang", "source", "text")
    parts = 1 + (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // TEXT_BYTES
    counted = texts.mapInArrow(lambda batches: _counted(batches, parts),
                               "part int, langs array<string>, sources array<string>, chunks array<string>, rows binary")
    rows = (counted.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(_tokenized, "lang string, source string, term string, n bigint, most bigint, least bigint"))
    terms = stored(rows.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("most").alias("most"), F.max("least").alias("least")), "source-terms")
    bounds = stored(terms.groupBy("lang", "term").agg(F.sum("most").alias("most"), F.sum("least").alias("least"))
                    .where(F.col("most") >= min_docs), "term-bounds")
    unsure = bounds.where(F.col("least") < min_docs).select("lang", "term")
    bitmap = _bitmap(unsure)
    met = (texts.mapInArrow(lambda batches: _listed(batches, bitmap), "lang string, term string, id bigint")
           .join(small_enough(unsure), ["lang", "term"], "left_semi").distinct()
           .groupBy("lang", "term").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs))
    kept = stored(bounds.where(F.col("least") >= min_docs).select("lang", "term")
                  .unionByName(met.select("lang", "term")), "kept-terms")
    counts = terms.select("lang", "source", "term", "n").join(small_enough(kept), ["lang", "term"], "left_semi")
    return stored(counts.select("lang", "source", "term", "n"), "kept-counts"), kept


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)) in exact integers; null without kept terms."""
    return F.expr(f"1 + (cast({n} + 2 as decimal(28,0)) * {SCALE}) div nullif(cast({total} + 2 * {kept} as decimal(28,0)), 0)")


def _pair_sums(groups):
    """Partial sums (lang, x, y, value) over the terms of a block, for sources
    x of its first and y of its second block of sources. The rows without a
    term give each source's share of a term it does not have, and the number of
    terms of the block: those that no source here has count too."""
    for table in groups:
        lang, first, second = (table[c][0].as_py() for c in ("lang", "side_a", "side_b"))
        side, source = table["side"].to_numpy(), table["source"].combine_chunks().dictionary_encode()
        names, who = source.dictionary.to_pylist(), source.indices.to_numpy()
        share_ = table["p"].to_numpy()
        absent = pc.is_null(table["term"]).to_numpy(zero_copy_only=False)
        zero, of = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=np.int64)
        zero[who[absent]], of[who[absent]] = share_[absent], side[absent]
        a, b = np.flatnonzero(of == first), np.flatnonzero(of == second)
        term = table["term"].combine_chunks().filter(pa.array(~absent)).dictionary_encode()
        column, row, value = term.indices.to_numpy(), who[~absent], share_[~absent]
        apart, both = zero[b][None, :] - zero[a][:, None], zero[b][None, :] + zero[a][:, None]
        sums = (pc.max(table["terms"]).as_py() - len(term.dictionary)) * (apart * apart // np.maximum(both, 1))
        step = max(1, CELLS // max(1, len(names)))
        order = np.argsort(column, kind="stable")
        column, row, value = column[order], row[order], value[order]
        for lo in range(0, len(term.dictionary), step):
            hi = min(lo + step, len(term.dictionary))
            i, j = np.searchsorted(column, [lo, hi])
            p = np.repeat(zero[:, None], hi - lo, axis=1)
            p[row[i:j], column[i:j] - lo] = value[i:j]
            q = p[b]
            for k, x in enumerate(a):
                apart = q - p[x]
                sums[k] += (apart * apart // (q + p[x])).sum(axis=1)
        x, y = np.repeat(a, len(b)), np.tile(b, len(a))
        # Within a side a pair goes by its names, whose numbers differ from block to block.
        once = [i for i in range(len(x)) if first != second or names[x[i]] < names[y[i]]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(once), pa.string()), pa.array([names[i] for i in x[once]], pa.string()),
             pa.array([names[i] for i in y[once]], pa.string()), pa.array(sums.ravel()[once])],
            names=["lang", "x", "y", "value"])


def _pairs(counts: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of sources of a lang."""
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK_SOURCES).cast("int").alias("sides"))
    placed = small_enough(stored(
        groups.join(small_enough(sizes), "lang")
        .withColumn("side", F.pmod(F.xxhash64("source"), F.col("sides")).cast("int"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") / BLOCK_TERMS)).cast("int"))
        .withColumn("p0", F.coalesce(share("0", "total", "kept"), F.lit(1))), "placed-sources"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    shares = (counts.join(placed, ["lang", "source"])
              .select("lang", "source", "side", "sides", block.alias("block"), "term",
                      share("n", "total", "kept").alias("p"), F.lit(0).cast("bigint").alias("terms")))
    sizes = (kept.join(small_enough(placed.select("lang", "blocks").distinct()), "lang")
             .groupBy("lang", block.alias("block")).agg(F.count("*").alias("terms")))
    zeros = placed.select("lang", "source", "side", "sides",
                          F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    zeros = (zeros.join(small_enough(stored(sizes, "block-sizes")), ["lang", "block"], "left")
             .select("lang", "source", "side", "sides", "block", "term", "p", F.coalesce("terms", F.lit(0)).alias("terms")))
    met = (shares.unionByName(zeros).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
           .withColumn("side_a", F.least("side", "other")).withColumn("side_b", F.greatest("side", "other"))
           .drop("sides", "other"))
    sums = (per_group(met, ["lang", "block", "side_a", "side_b"], [], _pair_sums,
                      "lang string, x string, y string, value bigint")
            .groupBy("lang", "x", "y").agg(F.sum("value").alias("value")))
    sums = stored(sums, "pair-sums")
    return (sums.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "value")
            .unionByName(sums.select("lang", F.col("y").alias("source"), F.col("x").alias("item"), "value")))


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank); see module."""
    require(docs, "text", "lang", "source")
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts, kept = term_counts(docs, min_docs)
    n_kept = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        docs.select("lang", "source").distinct().join(small_enough(stored(totals, "totals")), ["lang", "source"], "left")
        .join(small_enough(stored(n_kept, "kept-by-lang")), "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept")),
        "sources")
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    p = share("n", "total", "kept")
    q = share("lang_n", "lang_total", "kept")
    terms = (counts.join(of_lang, ["lang", "term"])
             .join(small_enough(groups), ["lang", "source"]).join(small_enough(stored(langs, "langs")), "lang")
             .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
             .select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    pairs = _pairs(counts, kept, groups).withColumn("rank", F.row_number().over(ranked))
    return (pairs.withColumn("part", F.lit("pair")).unionByName(best.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))
