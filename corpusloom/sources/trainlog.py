"""Training logs as typed tables of steps, evaluations and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.measures import elapsed_seconds
from corpusloom.operators.ordered import running

FILE = ["file"]

# The line shapes of the log format.
STEP_LINE = r"^step=\s*(\d+) \| loss=(\S+)"
EVAL_LINE = r"^\s*EVAL @ step ([\d,]+) \| elapsed (\S+)"
SAMPLES_LINE = r"^--- Sample generations at step (\d+) ---"
SAMPLES_END = "--- End samples ---"
RULE_LINE = "^={60}$"
PROMPT_MARK, OUTPUT_MARK = "  PROMPT: ", "  OUTPUT: "


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Log lines with their file, the input split they came from, and their order in it.

    One split is read by one task from front to back, so the running id orders its lines.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("part"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
    )


def _number(text: Column, kind: str) -> Column:
    return F.regexp_replace(text, ",", "").try_cast(kind)


def _part(pattern: str, kind: str, group: int = 1) -> Column:
    return _number(F.regexp_extract("value", pattern, group), kind)


def numbered_runs(rows: DataFrame) -> DataFrame:
    """Add ``run``: a file starts a new one when tokens fall or the step does not rise."""
    spread = rows.withColumn("_part", F.col("part"))
    before = {"_step": ("last", F.col("step")), "_tok": ("last", F.col("tok"))}
    seen = running(spread, FILE, "line", before, inclusive=False, block=F.col("_part"))
    fresh = seen.withColumn("_new", ((F.col("step") <= F.col("_step")) | (F.col("tok") < F.col("_tok"))).cast("int"))
    counted = running(fresh, FILE, "line", {"run": ("sum", F.coalesce("_new", F.lit(0)))}, block=F.col("_part"))
    return counted.drop("_step", "_tok", "_new", "_part")


def read_steps(lines: DataFrame) -> DataFrame:
    """One row per logged step; ``grad_norm`` stays text, as it may be N/A."""
    found = lines.filter(F.col("value").rlike(STEP_LINE)).select(
        "file",
        "part",
        "line",
        _part(STEP_LINE, "bigint").alias("step"),
        _part(STEP_LINE, "double", 2).alias("loss"),
        _part(r"lr=(\S+)", "double").alias("lr"),
        F.regexp_extract("value", r"grad_norm=(\S+)", 1).alias("grad_norm"),
        (_part(r"(\d+)K tok/s", "bigint") * 1000).alias("tok_per_sec"),
        _part(r"dt=([\d.]+)s", "double").alias("dt"),
        _part(r"tok=([\d,]+)", "bigint").alias("tok"),
        elapsed_seconds(F.regexp_extract("value", r"elapsed=(\S+)", 1)).alias("elapsed"),
    )
    return numbered_runs(found)


def _blocks(lines: DataFrame, header: str, name: str) -> DataFrame:
    """Number each line by the headers seen so far in its file."""
    is_header = F.col("value").rlike(header).cast("int")
    spread = lines.withColumn("_part", F.col("part"))
    return running(spread, FILE, "line", {name: ("sum", is_header)}, block=F.col("_part")).drop("_part")


def _found(pattern: str, kind: str) -> Column:
    """The first value a pattern yields inside a group of lines."""
    return F.max(F.when(F.col("value").rlike(pattern), _part(pattern, kind)))


def read_evals(lines: DataFrame) -> DataFrame:
    """One row per evaluation block."""
    fields = {
        "step": (EVAL_LINE, "bigint"),
        "val_loss": (r"^\s*Val Loss: (\S+)", "double"),
        "perplexity": (r"Perplexity: (\S+)", "double"),
        "train_loss": (r"^\s*Train Loss \(avg last 10\): (\S+)", "double"),
        "best_val_loss": (r"^\s*Best Val Loss: (\S+)", "double"),
        "tok": (r"^\s*Tokens Processed: ([\d,]+)", "bigint"),
    }
    any_field = "|".join(f"({p})" for p, _ in fields.values())
    numbered = _blocks(lines.filter(F.col("value").rlike(any_field)), EVAL_LINE, "block")
    elapsed = elapsed_seconds(F.regexp_extract("value", EVAL_LINE, 2))
    return (
        numbered.filter("block > 0")
        .groupBy("file", "block")
        .agg(
            *[_found(p, k).alias(n) for n, (p, k) in fields.items()],
            F.max(F.when(F.col("value").rlike(EVAL_LINE), elapsed)).alias("elapsed"),
        )
    )


def read_samples(lines: DataFrame) -> DataFrame:
    """One row per sample: step, ordinal, prompt, output (which may span lines).

    A block that a stopped run left open ends at the next step line or rule.
    """
    value = F.col("value")
    header, ends = value.rlike(SAMPLES_LINE), (value == SAMPLES_END) | value.rlike(STEP_LINE) | value.rlike(RULE_LINE)
    counts = {
        "block": ("sum", header.cast("int")),
        "_open": ("last", F.when(header, 1).when(ends, 0)),
        "sample": ("sum", value.rlike("^" + PROMPT_MARK).cast("int")),
        "step": ("last", F.when(header, _part(SAMPLES_LINE, "bigint"))),
    }
    # Prompts are counted through the file, so samples of a block are numbered again below.
    numbered = running(lines.withColumn("_part", F.col("part")), FILE, "line", counts, block=F.col("_part"))
    text = F.struct("part", "line", "value")
    bodies = (
        numbered.filter((F.col("_open") == 1) & ~header)
        .groupBy("file", "block", "sample", "step")
        .agg(F.transform(F.sort_array(F.collect_list(text)), lambda s: s["value"]).alias("_lines"))
        .filter(F.get("_lines", F.lit(0)).startswith(PROMPT_MARK))
    )
    prompt = F.substring(F.get("_lines", F.lit(0)), F.lit(len(PROMPT_MARK) + 1), F.length(F.get("_lines", F.lit(0))))
    body = F.array_join(F.slice("_lines", F.lit(2), F.greatest(F.size("_lines") - 1, F.lit(0))), "\n")
    # The writer puts one empty line after each output.
    output = F.regexp_replace(body, r"\n\z", "")
    return (
        bodies.select(
            "file",
            "block",
            "sample",
            "step",
            prompt.alias("prompt"),
            F.substring(output, F.lit(len(OUTPUT_MARK) + 1), F.length(output)).alias("output"),
        )
        .withColumn("sample", F.row_number().over(Window.partitionBy("file", "block").orderBy("sample")))
    )
