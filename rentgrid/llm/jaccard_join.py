"""N-gram Jaccard join by multiple global token orders.

Texts are sets of word shingles. Two texts link when their Jaccard similarity reaches
3/4 (any threshold can be given). A pair that links shares tokens in the prefixes of
both sets under *every* global order of the tokens, so several orders give several
necessary conditions; only pairs that pass all of them are verified.

1. **Classes.** Texts of equal sets are one class, named by a 64-bit fingerprint of
   the set, so copies cost nothing from here on, however many there are.
2. **First order**: by hash, tokens of many texts last (a shared passage then does not
   make candidates). Prefix tokens are shuffled as (token, class), and tokens of a
   single class, or of no two classes of fitting sizes, are dropped.
3. **Stars.** Each class is verified against one central class of its tokens' lists, one
   whose tokens are shared most. That joins large groups of near copies with a comparison
   per text.
4. **Rest.** In each token's list, pairs of *different* components within the size bounds
   are counted. A pair needs a number of common prefix tokens that follows from both
   sizes, so a class may leave out as many of its longest lists, less one, and meets a
   linked one in the others: a class that holds too few shared tokens makes no pair.
   What remains is checked under two more orders, and then verified on the whole sets.
   Pairs inside a component could add no new component, so the components are those of
   all links.

Exactness: shingles and sets are compared by 64-bit hashes; any two differ except with
a chance of 2**-64. The list of frequent tokens only changes the order: the join is
exact with any list. Its size is bounded (a token must hold 1/FREQUENT of all tokens).

Null and blank texts: empty set, linked with nothing. A row without an id takes part in
no link and has a null component. Rows of one id are documents of their own; repeated
rows are copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import BLOOM_BITS, bloom, in_bloom, keep, release_shuffles
from .texts import Words, mix, words

FREQUENT = 1 << 20  # entries of the broadcast list of frequent tokens, at most
LEAST_FREQUENT = 64
POSTED_AT_ONCE = 1 << 17
SLACK = 3  # lists beyond the necessary one in which a pair is counted


@dataclass(frozen=True)
class Similarity:
    """Link when ``over * intersection >= up * union``; ``width`` words a shingle."""

    up: int = 3
    over: int = 4
    width: int = 5

    def prefix(self, n):
        """Tokens of a set of ``n`` among which any linked set shares one."""
        return n - -(-n * self.up // self.over) + 1

    def overlap(self, n, m):
        """Least intersection of linked sets of ``n`` and ``m``."""
        return -(-(n + m) * self.up // (self.up + self.over))

    def shared_prefix(self, n, m):
        """Least number of common tokens of both prefixes, under any order.

        Order both prefixes; the one that ends first has all its common tokens inside
        the other's, and beyond it the set has size - prefix tokens more.
        """
        rest = np.maximum(n - self.prefix(n), m - self.prefix(m))
        return np.maximum(1, self.overlap(n, m) - rest)

    def sizes_fit(self, n, m):
        return self.over * np.minimum(n, m) >= self.up * np.maximum(n, m)


DEFAULT = Similarity()


def shingle_sets(part: Words, width: int):
    """Sorted distinct shingle hashes of each row of ``part``."""
    h = part.hashes()
    odd = mix(np.arange(11, 11 + width, dtype=np.uint64)) | np.uint64(1)
    if len(h) >= width:
        grams = np.zeros(len(h) - width + 1, dtype=np.uint64)
        for k in range(width):
            grams += h[k : len(h) - width + 1 + k] * odd[k]
        grams = mix(grams)
    else:
        grams = np.zeros(0, dtype=np.uint64)
    for a, b in zip(part.first[:-1], part.first[1:]):
        if b - a >= width:
            yield np.unique(grams[a : b - width + 1])
        elif b > a:
            yield mix(np.array([(h[a:b] * odd[: b - a]).sum() ^ odd[b - a]], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def fingerprint(tokens: np.ndarray) -> int:
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(tokens))])).view(np.int64)[0])


def _sets_of(column: pa.Array, width: int):
    for part in words(column):
        yield from shingle_sets(part, width)


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.int64))


def _repeated(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of two sets or more, their counts), ascending; empties ``sets``.

    Sorted in place: a worker holds the tokens of a batch about once.
    """
    tokens = np.concatenate(sets)
    sets.clear()
    tokens.sort()
    again = np.zeros(len(tokens) + 1, dtype=bool)  # equal to the one before
    again[1:-1] = tokens[1:] == tokens[:-1]
    first = np.flatnonzero(again[1:] & ~again[:-1])
    return tokens[first], np.flatnonzero(again[:-1] & ~again[1:]) - first + 1


def _survey(docs: DataFrame, how: Similarity) -> DataFrame:
    """Rows of documents (id, n, cls) and, with n null, of repeated tokens (id: token, cls: count)."""

    def task(batches):
        for batch in batches:
            n, cls, seen, tokens = [], [], set(), []
            for u in _sets_of(batch.column(1), how.width):
                n.append(len(u))
                cls.append(fingerprint(u))
                if cls[-1] not in seen:
                    seen.add(cls[-1])
                    tokens.append(u)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), _longs(cls)], ["id", "n", "cls"]
            )
            if tokens:
                values, counts = _repeated(tokens)
                yield pa.RecordBatch.from_arrays(
                    [_longs(values.view(np.int64)), pa.nulls(len(values), pa.int64()), _longs(counts)], ["id", "n", "cls"]
                )

    return docs.mapInArrow(task, "id long, n long, cls long")


def _frequent(survey: DataFrame) -> np.ndarray:
    """Sorted tokens of very many texts: at most FREQUENT, as each holds 1/FREQUENT of all.

    Counts leave out tokens seen once in a batch of rows: they only set the order.
    """
    total = survey.where("n is not null").agg(F.sum("n")).first()[0] or 0
    least = max(LEAST_FREQUENT, total // FREQUENT + 1)
    counts = survey.where("n is null").groupBy("id").agg(F.sum("cls").alias("c"))
    tokens = counts.where(F.col("c") >= least).select("id").toArrow()["id"].to_numpy()
    return np.sort(tokens.view(np.uint64))


def _first_prefix(u: np.ndarray, p: int, frequent: np.ndarray) -> np.ndarray:
    """Prefix by (frequent or not, hash)."""
    head = u[:p]
    if not len(frequent):
        return head
    at = np.minimum(np.searchsorted(frequent, head), len(frequent) - 1)
    if not (frequent[at] == head).any():
        return head
    at = np.minimum(np.searchsorted(frequent, u), len(frequent) - 1)
    late = frequent[at] == u
    return np.concatenate([u[~late], u[late]])[:p]


def _postings(docs: DataFrame, how: Similarity, frequent: np.ndarray) -> DataFrame:
    """(token, cls, n) of the first order's prefixes; tokens of one class are gone."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def task(batches):
        for batch in batches:
            seen, token, cls, n, size = set(), [], [], [], 0

            def flush():
                return pa.RecordBatch.from_arrays(
                    [_longs(np.concatenate(token).view(np.int64)), _longs(np.concatenate(cls)), pa.array(np.concatenate(n))],
                    ["token", "cls", "n"],
                )

            for u in _sets_of(batch.column(1), how.width):
                if not len(u) or (c := fingerprint(u)) in seen:
                    continue
                seen.add(c)
                # a copy: a part of the set would hold all of it in memory
                head = _first_prefix(u, how.prefix(len(u)), held.value).copy()
                token.append(head)
                cls.append(np.full(len(head), c, dtype=np.int64))
                n.append(np.full(len(head), len(u), dtype=np.int32))
                size += len(head)
                if size >= POSTED_AT_ONCE:
                    yield flush()
                    token, cls, n, size = [], [], [], 0
            if token:
                yield flush()

    rows = docs.mapInArrow(task, "token long, cls long, n int")
    ordered = rows.repartition("token").sortWithinPartitions("token", "cls")

    def shared(batches):
        return _shared_tokens(batches, how)

    return ordered.mapInArrow(shared, "token long, cls long, n int")


def _partnered(token: np.ndarray, n: np.ndarray, how: Similarity) -> np.ndarray:
    """Rows whose token has another row of a fitting size."""
    order = np.lexsort((n, token))
    t, m = token[order], n[order].astype(np.int64)
    near = (t[1:] == t[:-1]) & (how.over * m[:-1] >= how.up * m[1:])
    out = np.zeros(len(token), dtype=bool)
    out[order] = np.r_[near, False] | np.r_[False, near]
    return out


def _shared_tokens(batches, how: Similarity):
    """Keep tokens of two classes or more; rows come sorted.

    The last token's rows seen so far need only its first class and whether it was
    shown already, so a list of any length streams through. In lists that lie inside a
    batch, rows without a partner of a fitting size go too.
    """
    last = None  # token, first class, its n, already out, last class
    for batch in batches:
        if not batch.num_rows:
            continue
        token, cls, n = (batch.column(i).to_numpy() for i in range(3))
        first = np.ones(len(token), dtype=bool)
        first[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        token, cls, n = token[first], cls[first], n[first]
        shown = False
        if last is not None and token[0] == last[0]:
            if cls[0] == last[4]:
                token, cls, n = token[1:], cls[1:], n[1:]
            token, cls, n = np.r_[last[0], token], np.r_[last[1], cls], np.r_[last[2], n]
            shown = last[3]
        start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        size = np.diff(np.r_[start, len(token)])
        out = np.repeat(size > 1, size)
        done = shown or bool(size[-1] > 1)
        if shown:
            out[0] = False
            if size[0] > 1:
                out[1 : size[0]] = True
            done = shown if len(start) == 1 else bool(size[-1] > 1)
        last = (token[-1], cls[start[-1]], n[start[-1]], done, cls[-1])
        inside = (token != token[0]) & (token != token[-1])
        out &= ~inside | _partnered(token, n, how)
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[out]) for x in (token, cls, n)], ["token", "cls", "n"]
            )


def _stars(postings: DataFrame, how: Similarity) -> DataFrame:
    """One candidate (a, b) per class: the hub of most of its tokens, if a sixteenth or more.

    A list's hub is the class with the largest share of prefix tokens that others have
    too. These candidates only save comparisons; what they miss is found among the rest.
    """
    shared = postings.groupBy("cls").agg(F.count("*").alias("w"))
    rows = postings.join(shared, "cls").select("token", "cls", "n", (F.col("w") / F.col("n")).alias("w"))

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            token, cls, n, w = (batch.column(i).to_numpy() for i in range(4))
            order = np.lexsort((cls, -w, token))
            token, cls, n = token[order], cls[order], n[order].astype(np.int64)
            start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            hub = np.repeat(start, np.diff(np.r_[start, len(token)]))
            good = (cls != cls[hub]) & how.sizes_fit(n, n[hub])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[good]), pa.array(cls[hub][good]), pa.array(n[good])], ["a", "b", "n"]
            )

    votes = (
        rows.repartition("token").sortWithinPartitions("token").mapInArrow(task, "a long, b long, n long")
        .groupBy("a", "b").agg(F.count("*").alias("c"), F.first("n").alias("n"))
        .where(F.col("c") * 16 >= F.col("n"))
    )
    best = votes.groupBy("a").agg(F.max(F.struct("c", "b")).alias("best"))
    return best.select("a", F.col("best.b").alias("b"))


def _all_pairs(cls, n, comp, rank, lists, how: Similarity):
    """Pairs of different components and fitting sizes; the largest's members don't meet.

    ``n`` ascends. A linked pair shares ``shared_prefix`` lists, so of the lists of one of
    them, ranked from the longest, it shares one beyond that rank less one; SLACK more
    leave the count some power. That one is the class of fewer lists.
    """
    ids, inverse, counts = np.unique(comp, return_inverse=True, return_counts=True)
    largest = int(np.argmax(counts))
    for i in np.flatnonzero(inverse != largest) if len(ids) > 1 else ():
        lo = np.searchsorted(n, -(-int(n[i]) * how.up // how.over))
        hi = np.searchsorted(n, int(n[i]) * how.over // how.up, "right")
        j = np.arange(lo, hi)
        other = inverse[lo:hi]
        j = j[(other != inverse[i]) & ((other == largest) | (j < i))]
        mine = (lists[i] < lists[j]) | ((lists[i] == lists[j]) & (cls[i] < cls[j]))
        at = np.where(mine, rank[i], rank[j])
        yield i, j[at >= how.shared_prefix(n[i], n[j]) - SLACK]


def _lists(batches):
    """The columns of one token's rows at a time; rows come sorted by token."""
    kept = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
        cut = np.flatnonzero(np.r_[True, table[0][1:] != table[0][:-1]])
        for a, b in zip(cut, np.r_[cut[1:], len(table[0])]):
            own = [x[a:b] for x in table]
            if kept and kept[-1][0][0] != own[0][0]:
                yield [np.concatenate(x) for x in zip(*kept)]
                kept = []
            kept.append(own)
    if kept:
        yield [np.concatenate(x) for x in zip(*kept)]


def _rest(postings: DataFrame, labels: DataFrame, how: Similarity) -> DataFrame:
    """All candidate pairs (a, b) of different components under the first order.

    Only lists of several components count. A class meets others in its shortest lists
    alone, so what many texts share makes no pairs unless they share enough besides.
    """
    labels = labels.where("node <> component")
    by_token, by_class = Window.partitionBy("token"), Window.partitionBy("cls")
    rows = (
        postings.select("token", "cls", "n")
        .join(labels, F.col("cls") == F.col("node"), "left")
        .select("token", "cls", "n", F.coalesce("component", "cls").alias("comp"))
        .withColumn("size", F.count("*").over(by_token))
        .withColumn("mixed", F.min("comp").over(by_token) < F.max("comp").over(by_token))
        .where("mixed")
        .withColumn("rank", F.row_number().over(by_class.orderBy(F.desc("size"), "token")))
        .withColumn("lists", F.count("*").over(by_class))
        .select("token", "cls", F.col("n").cast("long").alias("n"), "comp", "rank", "lists")
        .repartition("token").sortWithinPartitions("token", "n", "cls")
    )

    def task(batches):
        def flush(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*found)], ["a", "b", "an", "bn"]
            )

        found, size = [], 0
        for _, cls, n, *others in _lists(batches):
            for i, j in _all_pairs(cls, n, *others, how):
                if len(j):
                    swap = cls[j] < cls[i]
                    found.append((
                        np.minimum(cls[j], cls[i]), np.maximum(cls[j], cls[i]),
                        np.where(swap, n[j], n[i]), np.where(swap, n[i], n[j]),
                    ))
                    size += len(j)
            if size > 100_000:
                yield flush(found)
                found, size = [], 0
        if found:
            yield flush(found)

    counted = (
        rows.mapInArrow(task, "a long, b long, an long, bn long")
        .groupBy("a", "b").agg(F.count("*").alias("c"), F.first("an").alias("an"), F.first("bn").alias("bn"))
    )
    up, over = how.up, how.over
    beyond = lambda x: F.expr(f"({x}n * {up} + {over - 1}) div {over} - 1")
    overlap = F.expr(f"((an + bn) * {up} + {up + over - 1}) div {up + over}")
    least = F.least(overlap - F.greatest(beyond("a"), beyond("b")), F.lit(SLACK + 1))
    return counted.where(F.col("c") >= least).select("a", "b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, how: Similarity) -> DataFrame:
    """The pairs of classes that link.

    The sets are made anew from the texts; any document of a class gives its set. A 1 MB
    filter leaves most others unread by Python, copies combine before the shuffle, and
    both joins below read one and the same shuffle of the sets.
    """
    wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    held = docs.sparkSession.sparkContext.broadcast(bloom(classes.join(wanted, "cls", "left_semi").select("rep")))

    def sets(batches):
        bits = np.unpackbits(np.frombuffer(held.value, dtype=np.uint8), count=BLOOM_BITS).astype(bool)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            take = in_bloom(bits, ids)
            if take.any():
                seen, own, tokens, size = set(), [], [], 0
                for u in _sets_of(batch.column(1).filter(pa.array(take)), how.width):
                    if not len(u) or (c := fingerprint(u)) in seen:
                        continue
                    seen.add(c)
                    own.append(c)
                    tokens.append(u.tobytes())
                    size += len(u)
                    if size >= POSTED_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([_longs(own), pa.array(tokens, pa.binary())], ["cls", "tokens"])
                        own, tokens, size = [], [], 0
                if own:
                    yield pa.RecordBatch.from_arrays([_longs(own), pa.array(tokens, pa.binary())], ["cls", "tokens"])

    by_class = docs.mapInArrow(sets, "cls long, tokens binary").dropDuplicates(["cls"])
    left = by_class.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    right = by_class.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))

    def verify(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(batch.column(3)[i].as_buffer(), dtype=np.uint64)
                good[i] = passes_orders(x, y, how) and linked(x, y, how)
            keys = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"])
            yield keys.filter(pa.array(good))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(verify, "a long, b long")


def passes_orders(x: np.ndarray, y: np.ndarray, how: Similarity) -> bool:
    """Enough common prefix tokens under two more orders: hash descending, and a second hash."""
    p, q = how.prefix(len(x)), how.prefix(len(y))
    least = how.shared_prefix(len(x), len(y))
    if len(np.intersect1d(x[-p:], y[-q:], assume_unique=True)) < least:
        return False
    again = np.sort(mix(x ^ np.uint64(0x5DEECE66D)))[:p], np.sort(mix(y ^ np.uint64(0x5DEECE66D)))[:q]
    return len(np.intersect1d(*again, assume_unique=True)) >= least


def linked(x: np.ndarray, y: np.ndarray, how: Similarity) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return how.over * common >= how.up * (len(x) + len(y) - common)


def near_duplicates(
    docs: DataFrame, id: str | Column = "doc_id", text: str | Column = "text", how: Similarity = DEFAULT
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row; other columns are left out."""
    spark = docs.sparkSession
    col = lambda c: F.col(c) if isinstance(c, str) else c
    docs = docs.select(col(id).cast("long").alias("id"), col(text).cast("string").alias("text"))
    survey = keep(_survey(docs, how), "shingled")
    rows = survey.where("n is not null")
    docs = docs.where("id is not null")
    classes = keep(rows.where("n > 0 and id is not null").groupBy("cls").agg(F.min("id").alias("rep")), "classes")
    postings = keep(_postings(docs, how, _frequent(survey)), "postings")
    release_shuffles(spark)
    links = keep(_verified(keep(_stars(postings, how), "stars"), docs, classes, how), "links")
    labels = components(links, "a", "b")
    release_shuffles(spark)
    candidates = keep(_rest(postings, labels, how), "candidates")
    if not candidates.isEmpty():
        links = links.unionByName(_verified(candidates, docs, classes, how))
    labels = keep(components(links, "a", "b"), "labels")
    named = classes.join(labels, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("component", "cls").alias("comp")
    )
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_class = keep(named.join(least, "comp").select("cls", "component_id"), "classes")
    own = F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component_id"))
    return rows.join(by_class, "cls", "left").select("id", F.col("n").alias("n_shingles"), own.alias("component_id"))
