"""Documents with Q&A texts to conversation records and to evaluation tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.functions.chat import exchange
from chatmill.functions.options import expand_questions, option_blocks, option_count
from chatmill.functions.prompts import DOCUMENT_PREAMBLE
from chatmill.functions.qa import parse_qa, qa_samples
from chatmill.operators.ordering import nth_key, seeded_shuffle
from chatmill.operators.pairing import orphans, pair_documents
from chatmill.operators.split import EVAL, TRAIN, with_split
from chatmill.sources.sinks import write_dataset

ROW_ID = ["stem", "block_no", "option_no"]


def _samples(docs: DataFrame, qa: DataFrame) -> DataFrame:
    """One row per expanded question, next to its document."""
    # Documents and Q&A texts meet one to one, before the questions are split out.
    return qa_samples(pair_documents(docs, qa))


def document_records(docs: DataFrame, qa: DataFrame, preamble: str = DOCUMENT_PREAMBLE) -> DataFrame:
    """(`stem`, `block_no`, `option_no`, `conversations`): document as system text, question, answer."""
    system = F.concat(F.lit(preamble), F.col("content"))
    return _samples(docs, qa).select(*ROW_ID, exchange(system, F.col("question"), F.col("answer")).alias("conversations"))


def document_dataset(
    docs: DataFrame, qa: DataFrame, share: float | None = None, seed: int = 42, preamble: str = DOCUMENT_PREAMBLE
) -> tuple[DataFrame, DataFrame | None]:
    """(train, eval) records. With a split, whole documents go to one side and train is shuffled."""
    pairs = pair_documents(docs, qa)

    def records(side: DataFrame) -> DataFrame:
        system = F.concat(F.lit(preamble), F.col("content"))
        return qa_samples(side).select(*ROW_ID, exchange(system, F.col("question"), F.col("answer")).alias("conversations"))

    def in_order(side: DataFrame) -> DataFrame:
        # Placed by document before the questions are split out, so that a document's text is moved once.
        return records(side.repartitionByRange("stem")).sortWithinPartitions(*ROW_ID)

    if share is None:
        return in_order(pairs), None
    # The split is over the pairs, also those that yield no sample; they are labelled once.
    labelled = with_split(pairs, "stem", share, seed)
    train, evaluation = (labelled.filter(F.col("split") == side).drop("split") for side in (TRAIN, EVAL))
    return seeded_shuffle(records(train), seed, ROW_ID), in_order(evaluation)


def document_rejects(docs: DataFrame, qa: DataFrame) -> DataFrame:
    """What the job leaves out: (`stem`, `block_no`, `head`, `fault`) of faulty Q&A blocks, and of texts without a partner."""

    def alone(side: DataFrame, fault: str) -> DataFrame:
        return side.select("stem", F.lit(None).cast("int").alias("block_no"), F.lit(None).cast("string").alias("head"), F.lit(fault).alias("fault"))

    blocks = parse_qa(pair_documents(docs.select("stem"), qa))[1].select("stem", "block_no", "head", "fault")
    return blocks.unionByName(alone(orphans(docs, qa), "no Q&A text")).unionByName(alone(orphans(qa, docs), "no document"))


def document_tasks(docs: DataFrame, qa: DataFrame, max_samples: int | None = None, preamble: str = DOCUMENT_PREAMBLE) -> DataFrame:
    """Evaluation tasks (`doc`, `system`, `question`, `ground_truth`); the cap counts expanded questions."""
    if max_samples is not None and max_samples < 1:
        raise ValueError("a cap must be at least 1; use None for all questions")
    blocks, _ = parse_qa(pair_documents(docs, qa))
    last = None
    if max_samples is not None:
        # The block that holds the last question is found from the blocks' numbers of questions, before any is expanded or meets its document.
        sizes, _ = parse_qa(qa.join(docs.select("stem"), "stem", "left_semi"))
        last = nth_key(sizes.select(F.struct("stem", "block_no").alias("key"), option_count(option_blocks(F.col("question"))).alias("n")), max_samples, weight="n")
    key = F.struct("stem", "block_no")
    samples = expand_questions(blocks if last is None else blocks.filter(key <= last[0]))
    if last is not None:
        samples = samples.filter((key < last[0]) | (F.col("option_no") < last[1]))
    tasks = samples.select(
        *ROW_ID,
        F.col("stem").alias("doc"),
        F.concat(F.lit(preamble), F.col("content")).alias("system"),
        "question",
        F.col("answer").alias("ground_truth"),
    )
    return tasks if max_samples is None else tasks.orderBy(*ROW_ID)


def prepare_documents(docs: DataFrame, qa: DataFrame, path: str, share: float | None = None, seed: int = 42, preamble: str = DOCUMENT_PREAMBLE, dry: bool = False) -> DataFrame:
    """The whole job: records of both sides written as JSON lines, or only counted in a `dry` run; (`side`, `path`, `records`)."""
    return write_dataset(*document_dataset(docs, qa, share, seed, preamble), path, dry)
