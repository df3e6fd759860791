"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next.

quality classifier -> exact dedup -> SimHash near-dedup -> mixing sources to target weights -> packing. All stages
but the last return the columns of documents; the last returns a row for every piece of a sequence.

Defined results, of every stage: a null text counts as empty and stays null; a null identifier is a document like any
other, but for the near-dedup, which leaves it in; rows that repeat an identifier are decided one by one (quality),
as one document if they repeat the text too (exact dedup, mixing), and go together where the identifier decides
(near-dedup); ties go to the smallest identifier; very long texts are read as a whole; an empty table gives an empty
one; further columns of documents, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import exact_dedup, mixing, packing, quality, shingle_join, simhash
from tidewright.llm.common import kept, materialize, release, scratch

#: Every source is read once as a whole; small ones repeat until the flattest mixture that reads none over twice.
MIX = mixing.Target(max_repetition=2.0)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose probability of the top grade is below one half; without usable labels it rejects none.

    An empty text is graded by its (lack of) features as any other; a probability of exactly one half is kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.drop_poor(docs, quality.train(docs, quality.grades_of_labels(labels)))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the owner of every group of texts equal but for white space: the longest, then the smallest identifier.

    Empty and null texts are one group; a row without identifier owns a group only if all of it have none.
    """
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every component of near copies, the one of the smallest identifier.

    Near are texts whose SimHash fingerprints are at most two bits apart and whose 5-word shingles, repeats included as
    in a fingerprint, have a similarity of at least 0.8; and texts whose sets of 5-word shingles have it. SimHash balls
    find the first, among them texts that one repeated line fills and that have little else in common. Of the second
    they find few: a pair at 0.8 differs in about ten of 64 bits, and no ball that can be emitted reaches so far, so an
    exact join of leading shingles adds the others (`shingle_join`) and skips what the balls have connected. Rows
    without identifier stay; rows that share an identifier go or stay together; empty texts are copies of one another.
    """
    with scratch():
        balls = simhash.near_links(docs, width=5, max_bits=2, similarity="0.8")
        return shingle_join.drop_linked(docs, shingle_join.shingle_links(docs, width=5, similarity="0.8", known=balls))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources so that the sources reach their target weights; loses none.

    A null source is a source of its own; documents without tokens come once with their block.
    """
    return mixing.mix_documents(docs, MIX)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixture, laid into sequences of 2048; every copy of a document is packed.

    An empty text is its end id alone; pieces of equal cost are laid in the order in which they are read.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: A trained classifier, XXH64 fingerprints and a BPE tokenizer are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, in order; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before = docs
        with scratch():  # what a stage writes for itself goes with its end, and its input once the output is there
            docs = kept(materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}"))
        release(before)
    return docs
