"""Near duplicates by BagMinHash over multisets of word shingles.

A text is the multiset of its runs of five lower-case words, a count being a weight. Weights are
cut into the levels 0, 1, 2, 3 ... and each level of each shingle has a Poisson process of marked
points, the same wherever that shingle occurs. The levels form a hierarchy (0, 1, 2-3, 4-7 ...): one process
serves a whole interval, its points fall on one of its levels, and those above the weight
are left out, so a count of n costs log n processes. Each register keeps the earliest point that
marks it. Points are made in order of time up to a limit at which almost every register is full,
and further only for texts that need it. Two texts agree in a register with the probability of
their weighted Jaccard similarity, without bias.

Registers are banded. Texts that share a band are candidates; a pair is linked when its exact
multiset similarity reaches the threshold. Equal texts are one node from the start. Within a band's
bucket no list of all pairs is made: everyone is compared with one centre, in several rounds with new
centres for those still apart from it; in the end those outside a bucket's largest class are
compared with all members of other classes, so no link between classes is left unseen. That last
comparison moves blocks of about ``BLOCK_BYTES`` of texts, not pairs: inside a task a pair is
looked at in the first band it shares, skipped when far too few registers agree (a pair at the
threshold fails that once in a million), and then verified exactly. Classes are
connected components, by rounds of smallest labels with jumps, each stored.

Defined results: null counts as empty text. Texts without words are alike only when equal; fewer
than five words are one shingle. ``class_id`` is the smallest doc_id of the class, null when all
are null. Every row is kept, repeated ones too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import U64, Rolling, Words, blocks, lists, mix
from tidemark.llm.names import fresh
from tidemark.llm.repeats import within
from tidemark.scratch import Scratch

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 36, 5  # a pair at the threshold shares no band once in 1,600,000
STAR_ROUNDS = 3
BLOCK_BYTES, TEXT_BYTES = 2 << 20, 4 << 10  # about so much text on either side of a comparison; what a text counts besides its length
AGREE = 0.8  # of the registers that a pair at the threshold shares on average
STEP = U64(0x9E3779B97F4A7C15)


def shingles(column, size=SHINGLE):
    """Distinct shingles of each text in turn, with counts, and how many each text has."""
    words = Words(pc.utf8_lower(column))
    counts = words.counts()
    sizes = np.minimum(counts, size)
    each = np.maximum(counts - size + 1, np.minimum(counts, 1))
    starts = within(words.firsts[:-1], each)
    owner = np.repeat(np.arange(len(counts)), each)
    hashes = Rolling(words.codes).hashes(starts, starts + sizes[owner])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    firsts = np.flatnonzero(new)
    return hashes[firsts], np.diff(firsts, append=len(hashes)), np.bincount(owner[firsts], minlength=len(counts))


def _points(registers, hashes, weights, owner, limit):
    """Lower each owner's registers by all points of its shingles up to its time limit."""
    n_registers = registers.shape[1]
    flat = registers.reshape(-1)
    interval = 0
    while len(hashes):
        # interval 0 is level 0, interval i > 0 the levels 2**(i-1) .. 2**i - 1
        first = 0 if interval == 0 else 1 << (interval - 1)
        width = max(1, first)
        state = mix(hashes + U64((interval + 1) * int(STEP) % (1 << 64)))
        at, whose, weight = np.zeros(len(hashes)), owner, weights
        while len(state):
            state = mix(state + STEP)
            at = at - np.log(((state >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            alive = at <= limit[whose]
            state, at, whose, weight = state[alive], at[alive], whose[alive], weight[alive]
            mark = mix(state ^ U64(0x5851F42D4C957F2D))
            level = first + ((mark >> U64(40)) & U64(width - 1)).astype(np.int64)
            low = level < weight
            place = (mark & U64(0xFFFFFFFF)) * U64(n_registers) >> U64(32)
            np.minimum.at(flat, (whose * n_registers + place.astype(np.int64))[low], at[low])
        interval += 1
        more = weights > (1 << (interval - 1))
        hashes, weights, owner = hashes[more], weights[more], owner[more]


def signatures(hashes, weights, counts, n_registers=BANDS * ROWS):
    """Registers of each text: the time of the earliest point, infinite for a text without shingles."""
    n = len(counts)
    owner = np.repeat(np.arange(n), counts)
    total = np.bincount(owner, weights, minlength=n)
    registers = np.full((n, n_registers), np.inf)
    limit = n_registers * (np.log(n_registers) + 4) / np.maximum(total, 1)
    waiting = counts > 0
    while waiting.any():
        mine = waiting[owner]
        _points(registers, hashes[mine], weights[mine], owner[mine], limit)
        waiting &= np.isinf(registers).any(1)
        limit = limit * 4
    return registers


def band_keys(registers, bands=BANDS, rows=ROWS):
    """One hash per band and text."""
    bits = registers.view(U64).reshape(len(registers), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * STEP, bits.shape[:2])
    for row in range(rows):
        keys = mix(keys * U64(3) + bits[:, :, row])
    return keys


def text_id(text="text"):
    """Equal texts have equal ids."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def banded(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, bytes, bands, marks`` of each row; marks are eight bits of each register, bytes what
    the text counts in a block of comparisons."""

    def run(batches):
        for block in blocks(batches):
            column = block.column("text").fill_null("")
            found = shingles(column)
            registers = signatures(*found)
            keys, full = band_keys(registers), found[2] > 0
            values = lists(keys[full].view(np.int64).ravel(), np.where(full, BANDS, 0))
            marks = pa.array([row.tobytes() for row in (mix(registers.view(U64)) >> U64(56)).astype(np.uint8)], pa.binary())
            columns = [block.column("doc_id"), block.column("text_id"), block.column("bytes"), values, marks]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_id", "bytes", "bands", "marks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + TEXT_BYTES).cast("long").alias("bytes")
    return docs.select("doc_id", text_id().alias("text_id"), size, "text").mapInArrow(run, f"doc_id {kind}, text_id binary, bytes long, bands array<long>, marks binary")


def similarity(one, other):
    """Exact weighted Jaccard similarity of two texts' shingle counts, as a pair of integers."""
    (a, m), (b, n) = one, other
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = int(np.minimum(m[i], n[j]).sum())
    return common, int(m.sum() + n.sum()) - common


def _alike(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose texts are similar enough."""

    def run(batches):
        known, last = None, None
        for block in blocks(batches, "other_text"):
            keep = []
            found, weights, counts = shingles(block.column("other_text"))
            ends = np.cumsum(counts)
            for number, (center, text) in enumerate(zip(block.column("center"), block.column("center_text"))):
                if center.as_py() != last:
                    known, last = shingles(pa.array([text.as_py()]))[:2], center.as_py()
                part = slice(ends[number] - counts[number], ends[number])
                common, union = similarity(known, (found[part], weights[part]))
                keep.append(union > 0 and common >= threshold * union - 1e-9)
            yield pa.RecordBatch.from_arrays([block.column("center"), block.column("other")], ["a", "b"]).filter(pa.array(keep))

    return pairs.select("center", "other", "center_text", "other_text").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, label``: the smallest node of each connected component, for nodes with links ``a, b``."""
    edges = scratch.keep(links.select("a", "b").unionAll(links.select("b", "a")).distinct(), "edges")
    labels = scratch.keep(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        # jump: take the label that the label's own node has
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        fresh = scratch.keep(lower.join(jump, "label").select("node", "was", F.least("label", "further").alias("label")), "labels")
        labels = fresh.select("node", "label")
        if fresh.filter("label <> was").isEmpty():
            return labels


def _labelled(members, labels):
    return members.join(labels, F.col("text_id") == F.col("node"), "left").select("bucket", "text_id", "bytes", F.coalesce("label", "text_id").alias("label"))


def _star(here, number):
    """Everyone against one centre of the bucket, where their classes differ."""
    draw = F.xxhash64("text_id", F.lit(number))
    centers = here.groupBy("bucket").agg(F.min(F.struct(draw.alias("draw"), F.col("text_id").alias("center"), F.col("label").alias("own"))).alias("c"))
    centers = centers.select("bucket", "c.center", "c.own")
    return here.join(centers, "bucket").filter("label <> own").select("center", F.col("text_id").alias("other"))


def _compare_block(table, threshold):
    """Links between outsiders and members of other classes in one block of a bucket."""
    bucket = table.column("bucket")[0].as_py()
    ids, labels, outside, as_outsider = (table.column(c).to_pylist() for c in ("text_id", "label", "outside", "as_outsider"))
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(len(ids), -1)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    bags = []
    for block in blocks(table.select(["text"]).to_batches()):
        hashes, weights, counts = shingles(block.column("text"))
        ends = np.cumsum(counts)
        bags += [(hashes[e - n : e], weights[e - n : e]) for e, n in zip(ends, counts)]
    band = int(np.flatnonzero(bands[0] == bucket)[0])
    members = np.array([i for i, x in enumerate(as_outsider) if not x], int)
    joined, links = {}, []

    def root(label):
        while label in joined:
            label = joined[label]
        return label

    for i in np.flatnonzero(as_outsider):
        likely = members[(marks[members] == marks[i]).sum(1) >= AGREE * threshold * marks.shape[1]]
        for j in likely:
            if (outside[j] and ids[j] < ids[i]) or (bands[i, :band] == bands[j, :band]).any():
                continue
            one, other = root(labels[i]), root(labels[j])
            if one == other:
                continue
            common, union = similarity(bags[i], bags[j])
            if common >= threshold * union - 1e-9:
                joined[one] = other
                links.append((ids[i], ids[j]))
    return pa.table({"a": pa.array([a for a, _ in links], pa.binary()), "b": pa.array([b for _, b in links], pa.binary())})


def _across(here, bodies, threshold):
    """Links between members outside a bucket's largest class and members of other classes."""
    sizes = here.groupBy("bucket", "label").agg(F.sum("bytes").alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("all"))
    parts = lambda n: F.ceil(n / BLOCK_BYTES).cast("int")
    sizes = sizes.select("bucket", F.col("m.label").alias("main"), parts(F.col("all")).alias("across"), parts(F.col("all") - F.col("m.n")).alias("down"))
    marked = here.join(sizes, "bucket").withColumn("outside", F.col("label") != F.col("main"))
    part = lambda n, seed: F.pmod(F.xxhash64("text_id", F.lit(seed)), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ["bucket", "text_id", "label", "outside"]
    members = marked.select(*names, F.lit(False).alias("as_outsider"), every("down").alias("i"), part(F.col("across"), 1).alias("j"))
    outsiders = marked.filter("outside").select(*names, F.lit(True), part(F.col("down"), 2), every("across"))
    blocks_ = members.unionAll(outsiders).join(bodies, "text_id")
    return blocks_.groupBy("bucket", "i", "j").applyInArrow(lambda table: _compare_block(table, threshold), "a binary, b binary")


def classes(docs: DataFrame, threshold: float = SIMILARITY, star_rounds: int = STAR_ROUNDS) -> DataFrame:
    """``doc_id, text_id, class_id, class_text`` of each row; ``class_text`` is the text_id of the class's first document."""
    scratch = Scratch(docs.sparkSession)
    signed = scratch.keep(banded(docs), "signatures")
    texts = signed.groupBy("text_id").agg(F.first("bytes").alias("bytes"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    members = texts.select("text_id", "bytes", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = scratch.keep(members.join(shared, "bucket"), "members")
    known = members.select("text_id").distinct()
    bodies = docs.select(text_id().alias("text_id"), F.coalesce("text", F.lit("")).alias("text")).join(known, "text_id", "left_semi")
    bodies = scratch.keep(bodies.groupBy("text_id").agg(F.first("text").alias("text")).join(texts.drop("bytes"), "text_id"), "bodies")

    labels = links = None
    for number in range(star_rounds + 1):
        here = members.select("bucket", "text_id", "bytes", F.col("text_id").alias("label")) if labels is None else _labelled(members, labels)
        mixed = here.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
        here = scratch.keep(here.join(mixed, "bucket", "left_semi"), "here")
        if number == star_rounds:
            found = scratch.keep(_across(here, bodies, threshold), "links")
        else:
            pairs = scratch.keep(_star(here, number).distinct(), "pairs")
            met = pairs.join(bodies.select(F.col("text_id").alias("other"), F.col("text").alias("other_text")), "other").join(
                bodies.select(F.col("text_id").alias("center"), F.col("text").alias("center_text")), "center")
            found = scratch.keep(_alike(met, threshold), "links")
        links = found if links is None else links.unionAll(found)
        labels = components(links, scratch)

    texts = signed.groupBy("text_id").agg(F.min("doc_id").alias("first"))
    texts = texts.join(labels, F.col("text_id") == F.col("node"), "left").select("text_id", "first", F.coalesce("label", "text_id").alias("label"))
    texts = scratch.keep(texts, "texts")
    heads = texts.groupBy("label").agg(F.min(F.struct(F.col("first").isNull(), "first", "text_id")).alias("h"))
    named = texts.join(heads, "label").select("text_id", F.col("h.first").alias("class_id"), F.col("h.text_id").alias("class_text"))
    return signed.select("doc_id", "text_id").join(named, "text_id").select("doc_id", "text_id", "class_id", "class_text")


def first_of_each(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row of each class with all its columns: its smallest doc_id, repeated rows once."""
    key, head_text, head_id = fresh(["head_key", "head_text", "head_id"], docs.columns)
    heads = classes(docs, threshold).select(F.col("class_text").alias(head_text), F.col("class_id").alias(head_id)).distinct()
    kept = docs.withColumn(key, text_id()).join(heads, (F.col(key) == F.col(head_text)) & F.col("doc_id").eqNullSafe(F.col(head_id)), "left_semi")
    return kept.dropDuplicates([key]).drop(key)
