"""Removal of repeated passages: runs of lines with 50 words or more, and content-defined chunks of lines, that occur more than once in the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countflow.llm.bloom import may_repeat, plain_names, split_members
from countflow.llm.skew import join_back
from countflow.session import checkpoint

#: A line with as many words is a chunk of its own. Any run of lines with as many is removed if it repeats.
LONG_LINE = 50
#: Most windows are filled by as many lines.
FEW_LINES = 8
#: A repeated chunk of several lines goes if it has as many words: any that isn't blank.
LEAST_WORDS = 1
WORD = "[^\\x20\\x09-\\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def places_of(text: Column) -> Column:
    """The text's passages that count: array of struct(begin, lines, hash), each once, without Python.

    Chunks: a line ends a chunk if the rolling hash over it and the line before is smaller than those of both neighbours, if it or the next
    is long, or if it is the last. Chunks of several lines count from ``LEAST_WORDS`` words on.

    Windows: from each line with words on, and back from each, the fewest lines that hold ``LONG_LINE`` words. They depend on nothing around
    them, and any run of lines with so many words is covered by windows that lie in it: a line by the one that ends there if the run has
    enough words up to it, else by the one from the run's first line.
    """

    def cut(lines: Column) -> Column:
        facts = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))
        return _let(facts, lambda f: _let(F.transform(f, lambda x, i: F.xxhash64(F.coalesce(F.get(f, i - 1)["h"], F.lit(0).cast("bigint")), x["h"])), lambda r: places(f, r)))

    def places(facts: Column, rolled: Column) -> Column:
        filled = F.filter(F.sequence(F.lit(0), F.size(facts) - 1), lambda i: F.get(facts, i)["w"] > 0)
        # a span in one integer, because array_union compares structs pair by pair and integers by a hash set
        spans = F.array_union(packed(chunks(facts, rolled)), packed(_let(filled, lambda own: windows(facts, own))))
        parts = F.transform(spans, lambda s: span(F.shiftright(s, 32).cast("int"), s.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")))
        return _let(facts["h"], lambda h: F.transform(parts, lambda s: F.struct(s["begin"].alias("begin"), s["lines"].alias("lines"), F.xxhash64(F.slice(h, s["begin"] + 1, s["lines"])).alias("hash"))))

    def chunks(facts: Column, rolled: Column) -> Column:
        n = F.size(facts)

        def ends(i: Column) -> Column:
            least = (F.get(rolled, i) < F.get(rolled, i - 1)) & (F.get(rolled, i) < F.get(rolled, i + 1))
            return F.coalesce(least, F.lit(False)) | (F.get(facts, i)["w"] >= LONG_LINE) | (F.coalesce(F.get(facts, i + 1)["w"], F.lit(LONG_LINE)) >= LONG_LINE)

        def counts(s: Column) -> Column:
            words = F.aggregate(F.slice(facts, s["begin"] + 1, s["lines"]), F.lit(0), lambda acc, x: acc + x["w"])
            return _let(words, lambda w: ((s["lines"] >= 2) & (w >= LEAST_WORDS)) | (w >= LONG_LINE))

        begins = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | ends(i - 1))
        return F.filter(_let(begins, lambda b: F.transform(b, lambda i, k: span(i, F.coalesce(F.get(b, k + 1), n) - i))), counts)

    def windows(facts: Column, own: Column) -> Column:
        def reach(part: Column) -> Column:
            """The line of ``part`` that fills the window, and the words up to it."""
            start = F.struct(F.lit(0).alias("w"), F.lit(0).alias("at"))
            return F.aggregate(part, start, lambda acc, i: F.when(acc["w"] >= LONG_LINE, acc).otherwise(F.struct((acc["w"] + F.get(facts, i)["w"]).alias("w"), i.alias("at"))))

        def filled(part: Callable[[int], Column]) -> Column:
            # few lines are enough for most; as many as words always are
            return _let(reach(part(FEW_LINES)), lambda few: F.when(few["w"] >= LONG_LINE, few).otherwise(reach(part(LONG_LINE))))

        def ahead(i: Column, k: Column) -> Column:
            return _let(filled(lambda most: F.slice(own, k + 1, most)), lambda r: F.when(r["w"] >= LONG_LINE, span(i, r["at"] - i + 1)))

        def back(i: Column, k: Column) -> Column:
            return _let(filled(lambda most: F.reverse(F.slice(own, F.greatest(k - most + 2, F.lit(1)), F.least(k + 1, F.lit(most))))), lambda r: F.when(r["w"] >= LONG_LINE, span(r["at"], i - r["at"] + 1)))

        return F.filter(F.concat(F.transform(own, ahead), F.transform(own, back)), lambda s: s.isNotNull())

    def packed(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.shiftleft(s["begin"].cast("bigint"), 32) + s["lines"].cast("bigint"))

    def span(begin: Column, count: Column) -> Column:
        return F.struct(begin.alias("begin"), count.alias("lines"))

    return _let(lines_of(text), cut)


def repeated_chunks(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The lines to remove: doc_id, mark (the text's XXH64), and _removed, an array of struct(begin, lines), which may overlap.

    Of equal passages the first in order of doc_id, text hash and line stays; one that overlaps it goes from the first's end on. Passages count as
    equal only after a comparison of their bytes.

    A Bloom filter over all passages' hashes (see bloom) tells which may repeat, and a count by hash which do. Only the bodies of those
    are shuffled, one for each task that has met them; an aggregate keeps the smallest and the largest body, which are equal if all are. Where
    two share a hash and differ, the passages of that hash are told apart by the SHA-256 of their bodies.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").isNotNull()).withColumn("mark", F.xxhash64("text"))
    places = checkpoint(rows.select("doc_id", "mark", F.explode(places_of(F.col("text"))).alias("c")).select("doc_id", "mark", "c.*"))
    maybe = checkpoint(may_repeat(places, "hash", places.count(), {"_maybe": 2}).filter("_maybe").drop("_maybe"))
    groups = maybe.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "begin", "lines")).alias("first"))
    again = checkpoint(join_back(maybe, checkpoint(groups.filter("n > 1")), "hash", "n", ["doc_id", "mark", "begin"]))
    spans = again.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_set(F.struct("begin", "lines", "hash")).alias("spans"))
    met = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    body = _let(lines_of(F.col("text")), lambda x: F.transform("spans", lambda s: F.struct(s["hash"].alias("hash"), F.array_join(F.slice(x, s["begin"] + 1, s["lines"]), "\n").alias("body"), s["begin"].alias("begin"), s["lines"].alias("lines"))))
    bodies = met.select(F.explode(body).alias("c")).groupBy("c.hash").agg(F.min("c.body").alias("low"), F.max("c.body").alias("high"))
    clash = checkpoint(bodies.filter("low <> high").select("hash"))
    if clash.limit(1).count():  # hashes that different bodies share: none in most corpora
        apart = met.select("doc_id", "mark", F.explode(body).alias("c")).select("doc_id", "mark", "c.begin", "c.lines", "c.hash", F.sha2("c.body", 256).alias("sha"))
        apart = checkpoint(apart.join(clash, "hash", "left_semi"))
        firsts = apart.groupBy("hash", "sha").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "mark", "begin", "lines")).alias("first")).filter("n > 1").drop("n")
        apart = apart.join(firsts, ["hash", "sha"])
        again = again.join(clash, "hash", "left_anti").select("doc_id", "mark", "begin", "lines", "first").unionByName(apart.select("doc_id", "mark", "begin", "lines", "first"))
    first, end = F.col("first"), F.col("begin") + F.col("lines")
    same = F.struct("doc_id", "mark").eqNullSafe(F.struct(first["doc_id"], first["mark"]))
    begin = F.when(same, F.greatest("begin", first["begin"] + first["lines"])).otherwise(F.col("begin"))
    left = again.select("doc_id", "mark", begin.alias("begin"), (end - begin).alias("lines")).filter("lines > 0")
    return left.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("begin", "lines")).alias("_removed"))


def drop_repeated_chunks(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", removed_lines: str | None = None) -> DataFrame:
    """``documents`` with the repeated chunks cut out of ``text``, and in ``removed_lines`` (if named) how many lines went.

    Every row stays, one that has lost all its lines with an empty text. Null texts stay null, empty ones empty. Rows that share id and text are one
    document: what is removed from one is removed from all. Only documents that may have lost lines are shuffled; a Bloom filter of
    their text hashes lets the others pass.
    """
    docs, back = plain_names(documents, text=text, **({} if doc_id == text else {"id": doc_id}))
    key = "id" if "id" in back else "text"
    found = checkpoint(repeated_chunks(docs, key, "text"))
    hit, rest = split_members(docs.withColumn("mark", F.xxhash64("text")), "mark", found, "mark")
    gone = found.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "_removed")
    hit = hit.join(gone, hit[key].eqNullSafe(gone["_id"]) & (hit["mark"] == gone["_mark"]), "left")
    lines, spans = lines_of(F.col("text")), F.col("_removed")
    numbers = F.flatten(F.transform(spans, lambda r: F.sequence(r["begin"], r["begin"] + r["lines"] - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
    hit = hit.withColumn("_left", F.when(spans.isNotNull(), left))
    cut = F.when(spans.isNull(), F.col("text")).otherwise(_let(lines, lambda x: F.array_join(F.transform("_left", lambda i: F.get(x, i)), "\n")))
    lost = F.when(spans.isNull(), 0).otherwise(F.size(lines) - F.size("_left"))
    out = {c: F.col(n) for n, c in back.items()}
    names = documents.columns + ([removed_lines] if removed_lines and removed_lines not in documents.columns else [])
    changed = {**out, text: cut, **({removed_lines: lost.cast("bigint")} if removed_lines else {})}
    same = {**out, **({removed_lines: F.lit(0).cast("bigint")} if removed_lines else {})}
    return hit.select(*[changed[c].alias(c) for c in names]).unionByName(rest.select(*[same[c].alias(c) for c in names]))


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_chunks(docs, removed_lines="removed_lines")
