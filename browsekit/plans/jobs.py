"""End-to-end jobs: hourly scoring (T7) and affinity training.

``build_*`` return DataFrames; ``run_*`` also write a caller's outputs (score log,
prediction log, delivery log, run log, outbox, model tables).  Building is not lazy
throughout: tables that several later steps read are written to the checkpoint folder
on the way (``session.materialize``), and ``expire_stage_tables`` removes them after.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import RunWindow
from ..session import (materialize, materialize_many, path_exists, read_file, replace_file,
                       stage_scope)
from ..operators import (affinity, continued, factors, features, inventory, outbox, recipients, recommend,
                         sequences)


@dataclass
class Training:
    vocabulary: DataFrame
    model: dict[str, DataFrame]
    reciprocal_ranks: DataFrame
    record: DataFrame
    served: dict[str, DataFrame] | None = None


def build_training(tables, start=config.TRAIN_START, fit_on_full: bool = False,
                   version: int | None = None, until: datetime | None = None,
                   serve: bool = False) -> Training:
    """Vocabulary, split, fit, evaluate, record.

    ``fit_on_full=True`` reproduces the reference, which fits on every
    sequence and so also on the test rows; the default fits on train.
    The training clicks (before ``until``, if given) are scanned once and written: the
    vocabulary, the evaluated model and, with ``serve``, the served model fitted on every
    sequence all come from those rows.  ``version`` is by default the time of training.
    """
    rows = materialize(sequences.training_views(tables, start, until=until))
    vocab = materialize(sequences.fit_vocabulary(rows))
    parts = sequences.train_test_split(rows)
    fit_part = "full" if fit_on_full else "train"
    names = list(dict.fromkeys((fit_part, "test", *(("full",) if serve else ()))))
    built = materialize_many(*[sequences.to_sequences(sequences.encode(parts[n], vocab)) for n in names])
    seq = dict(zip(names, built))
    fit_seq = seq[fit_part]
    if serve and fit_part != "full":
        model, served = concurrently(lambda: affinity.fit(fit_seq), lambda: affinity.fit(seq["full"]))
    else:
        model = affinity.fit(fit_seq)
        served = model if serve else None
    rr = affinity.reciprocal_ranks(seq["test"], model, affinity.universe_of(fit_seq))
    version = version if version is not None else time.time_ns() // 1_000_000
    record = affinity.model_record(affinity.mean_reciprocal_rank(rr), version)
    return Training(vocab, model, rr, record, served)


def compare_models(tables, start=config.TRAIN_START, seed: int = 0) -> DataFrame:
    """M6 of the counts and of the factors, both fitted on T4's train part and tested on its test
    part: ``(model, activity_type, mrr, sequences)``."""
    rows = materialize(sequences.training_views(tables, start))
    vocab = materialize(sequences.fit_vocabulary(rows))
    parts = sequences.train_test_split(rows)
    train, test = materialize_many(*[sequences.to_sequences(sequences.encode(parts[n], vocab))
                                     for n in ("train", "test")])
    counts, universe = affinity.fit(train), affinity.universe_of(train)
    by_factors = factors.fit(counts["transitions"].select("activity_type", "src", "dst", "pair_count"), seed=seed)
    ranks = {"counts": affinity.reciprocal_ranks(test, counts, universe),
             "factors": factors.reciprocal_ranks(test, by_factors, universe)}
    out = [affinity.mean_reciprocal_rank(rr).select(F.lit(name).alias("model"), "activity_type", "mrr", "sequences")
           for name, rr in ranks.items()]
    return out[0].unionByName(out[1])


def run_training(tables, path: str, start=config.TRAIN_START, until: datetime | None = None,
                 version: int | None = None, **kw) -> Training:
    """T8 with artefacts: everything is written into ``path``/versions/<version>, and only then
    the pointer ``path``/current is switched to it in one step, so a run that reads an
    earlier version goes on reading it, and a failed training publishes nothing.

    A version holds the vocabulary and the count tables to serve, fitted on every training
    sequence, and under ``evaluated`` the tables fitted as ``build_training`` does (by default on
    the train part), with the record of their test metrics.  Versions are named by the time of
    training in milliseconds; one that exists is not overwritten.
    """
    version = version if version is not None else time.time_ns() // 1_000_000
    base = f"{path.rstrip('/')}/versions/{version}"
    if path_exists(tables.spark, f"{base}/record/_SUCCESS"):
        raise ValueError(f"model version {version} exists")
    t = build_training(tables, start, version=version, until=until, serve=True, **kw)
    t.vocabulary.write.mode("overwrite").parquet(f"{base}/vocabulary")
    affinity.save_model(t.served, base)
    affinity.save_model(t.model, f"{base}/evaluated")
    t.record.write.mode("overwrite").parquet(f"{base}/record")
    replace_file(tables.spark, f"{path.rstrip('/')}/current", str(version))
    return t


def continue_training(tables, path: str, until: datetime, start=config.TRAIN_START,
                      version: int | None = None) -> str:
    """T8 without rescanning: publish a version that adds the clicks from the end of the current
    version's clicks up to ``until`` to its counts, and return its folder.

    The first call (or one after ``run_training``, which publishes no state) counts everything
    after ``start``.  Later ones scan their own clicks, let the vocabulary grow, so items keep
    their ids, and merge counts and newest items (``operators.continued``).  A version is complete before the
    pointer is switched and is computed from the one before it alone, so a failed call leaves
    the current version and is simply repeated.  ``until`` closes its clicks: rows that land
    later with earlier times are not counted, which the usual two hours of lag are for.
    """
    spark, base = tables.spark, path.rstrip("/")
    earlier = f"{base}/versions/{(read_file(spark, f'{base}/current') or '').strip()}"
    closed = read_file(spark, f"{earlier}/until")
    if closed is not None:
        done = datetime.fromisoformat(closed.strip())
        if until <= done:
            raise ValueError(f"clicks before {done} are counted already")
        start = done - timedelta(milliseconds=1)        # the lower bound is exclusive
    version = version if version is not None else time.time_ns() // 1_000_000
    home = f"{base}/versions/{version}"
    if path_exists(spark, f"{home}/until") or path_exists(spark, f"{home}/record/_SUCCESS"):
        raise ValueError(f"model version {version} exists")
    with stage_scope(spark):
        rows = materialize(sequences.training_views(tables, start, until=until))
        if closed is None:
            vocab, state = sequences.fit_vocabulary(rows), None
        else:
            vocab, served = load_serving(spark, path, int(earlier.rsplit("/", 1)[1]))
            vocab = sequences.grow_vocabulary(vocab, rows)
            state = continued.state_of(served, spark.read.parquet(f"{earlier}/recent"))
        vocab = materialize(vocab)
        state = continued.carry(state, materialize(sequences.transform(rows, vocab)))
        vocab.write.mode("overwrite").parquet(f"{home}/vocabulary")
        affinity.save_model(continued.model(state), home)
        state["recent"].write.mode("overwrite").parquet(f"{home}/recent")
    replace_file(spark, f"{home}/until", until.isoformat())
    replace_file(spark, f"{base}/current", str(version))
    return home


def model_path(spark, path: str, version: int | None = None) -> str:
    """The folder of a published version, by default the current one."""
    base = path.rstrip("/")
    name = str(version) if version is not None else read_file(spark, f"{base}/current")
    if not name:
        raise FileNotFoundError(f"no model has been published under {base}")
    return f"{base}/versions/{name.strip()}"


def load_serving(spark, path: str, version: int | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Vocabulary and serving tables of a version written by ``run_training`` (the current one),
    as the hourly run loads them (the reference downloads its fitted artefacts likewise).  The
    frames stay with the version that was current when they were loaded."""
    base = model_path(spark, path, version)
    return spark.read.parquet(f"{base}/vocabulary"), affinity.load_model(spark, base)


def serving_model(tables, start=config.TRAIN_START) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Vocabulary and a model fitted on every training sequence, as served."""
    rows = materialize(sequences.training_views(tables, start))
    vocab = materialize(sequences.fit_vocabulary(rows))
    seqs = materialize(sequences.to_sequences(sequences.encode(rows, vocab)))
    return vocab, affinity.fit(seqs)


def concurrently(*steps):
    """Run independent driver-side steps (each building and writing its own
    stage tables) on separate threads, so their Spark jobs run side by side;
    returns their results in order."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, len(steps))) as pool:
        futures = [pool.submit(step) for step in steps]
        return [f.result() for f in futures]


def prepare_run(tables, win: RunWindow, start=config.TRAIN_START):
    """The serving vocabulary and model, and this run's send scores, built
    as concurrent jobs (independent inputs)."""
    served, scores = concurrently(lambda: serving_model(tables, start),
                                  lambda: send_scores(tables, win))
    return (*served, scores)


@dataclass
class Scoring:
    score_rows: DataFrame
    recipients: DataFrame
    prediction_log: DataFrame
    best: DataFrame
    outbox: DataFrame
    written: dict[str, DataFrame] | None = None     # the outputs as read back from the run's partitions

    def as_written(self) -> Scoring:
        """The same run as its written outputs, for when its stage tables are gone."""
        return Scoring(self.written["score_rows"], None, self.written["prediction_log"], None,
                       self.written["outbox"], self.written)


def send_scores(tables, win: RunWindow) -> DataFrame:
    """T1 + M3: one send probability per email, written once (read by the
    score log and twice by the recipient choice)."""
    return materialize(features.send_probability(features.send_features(tables, win),
                                                 tables.send_params()))


def build_scoring(tables, win: RunWindow, vocab: DataFrame, model: dict[str, DataFrame],
                  n: int | None = None, score_log: DataFrame | None = None,
                  rollout_bits: int = 224, scores: DataFrame | None = None,
                  log_pred=None) -> Scoring:
    """The hourly run as one plan.

    ``score_log`` is the log as read back after this run's rows were
    appended; by default the fixture history plus this run's rows.
    ``log_pred`` optionally renders the prediction-log scores (a Column).
    """
    scores = scores if scores is not None else send_scores(tables, win)
    rows = recipients.score_log_rows(scores, win)
    log = score_log if score_log is not None else tables.score_history().unionByName(rows)
    users = recipients.select_recipients(scores, log, win)
    run = sequences.activity_sequences(sequences.scoring_views(tables, win), users, vocab)
    cands = run["views"].select("email", "activity_type", "activity", "item").distinct()
    preds = materialize(affinity.score(cands, run["sequences"], model))
    pid_scores = preds.where(F.col("activity_type") == "pid")
    cat_scores = preds.where(F.col("activity_type") == "cgid")
    pid_preds = recommend.product_predictions(pid_scores, run["pid_rows"])
    cat_preds = recommend.category_predictions(cat_scores)
    plog = outbox.prediction_log(pid_preds, cat_preds, win, pred=log_pred)
    stocked = inventory.in_stock(inventory.inventory_from_events(tables.inventory_events()))
    best = materialize(recommend.recommend(pid_scores, cat_scores, run["pid_rows"], tables,
                                           stocked))
    chosen = outbox.send_cap(outbox.rollout_gate(best, rollout_bits), n)
    return Scoring(rows, users, plog, best, outbox.payload(chosen))


def window_of(spark, out_dir: str, run, hosts=config.HOSTS) -> RunWindow:
    """S8 read side: the window of a run that follows the newest run in ``out_dir``'s run log
    (the hour before, if there is none)."""
    path = f"{out_dir.rstrip('/')}/run_log"
    last = None
    if path_exists(spark, path):
        log = spark.read.parquet(path).where(F.col("timestamp") < F.lit(run.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp"))
        text = outbox.last_run(log).select(F.date_format("last_run", "yyyy-MM-dd HH:mm:ss").alias("t")).first()["t"]
        last = datetime.strptime(text, "%Y-%m-%d %H:%M:%S") if text else None
    return RunWindow(run, last or run - timedelta(hours=1), hosts)


def run_folder(path: str, win: RunWindow) -> str:
    """The partition of a run in one of its tables."""
    return f"{path}/run_date={win.run:%Y-%m-%d}/run_time=t{win.run:%H%M%S}"


def _write_run(df: DataFrame, path: str, win: RunWindow, fmt: str = "parquet") -> None:
    """Write one run's rows as the partition of its day and time, replacing what an earlier
    attempt of the same run left there (also when there are no rows now), and nothing else."""
    df.write.mode("overwrite").format(fmt).save(run_folder(path, win))


def run_log_so_far(tables, base: str, win: RunWindow, delivered: DataFrame | None = None) -> DataFrame:
    """The score log of the resend window with its send flags: the log of earlier systems plus
    this job's own rows, marked as sent by the delivery log.  Days before the window are
    pruned by partition."""
    spark = tables.spark
    own = recipients.trailing(spark.read.parquet(f"{base}/score_log"), win)
    log = recipients.trailing(tables.score_history(), win).unionByName(
        own.select("email", "prob", "timestamp", "send_flag"))
    if delivered is None and path_exists(spark, f"{base}/delivery_log"):
        delivered = spark.read.parquet(f"{base}/delivery_log")
    if delivered is None:
        return log
    return outbox.sent_flags(log, recipients.trailing(delivered, win))


def run_scoring(tables, win: RunWindow | datetime, vocab: DataFrame, model: dict[str, DataFrame],
                out_dir: str, n: int | None = None, delivered: DataFrame | None = None,
                rollout_bits: int = 224, expire: bool = False) -> Scoring:
    """T7 with its writes: score log (written, then read back for T2), prediction log,
    outbox, delivery log and run log, each in the partition of its run, so a repeated run
    replaces its rows, also where it has none now.  The run log is written last: a run that is in
    it is complete.

    ``win`` may be the run's time alone: the window then starts at the last run in the run
    log.  ``delivered`` is the mailer's own delivery log ``(email, timestamp)``; without it
    everything in the outbox counts as delivered and this job writes the log.  With ``expire``
    the run's stage tables are removed at its end, whether it succeeds or fails, and
    ``recipients`` and ``best`` of the result are None.
    """
    if not expire:
        return _score_and_write(tables, win, vocab, model, out_dir, n, delivered, rollout_bits)
    with stage_scope(vocab.sparkSession):
        s = _score_and_write(tables, win, vocab, model, out_dir, n, delivered, rollout_bits)
    return s.as_written()


def _score_and_write(tables, win, vocab, model, out_dir, n, delivered, rollout_bits) -> Scoring:
    spark = vocab.sparkSession
    base = out_dir.rstrip("/")
    if isinstance(win, datetime):
        win = window_of(spark, base, win)
    scores = send_scores(tables, win)
    score_rows = recipients.score_log_rows(scores, win)
    _write_run(score_rows, f"{base}/score_log", win)
    earlier = delivered
    if earlier is None and path_exists(spark, f"{base}/delivery_log"):
        # a repeated run must not see its own deliveries
        earlier = spark.read.parquet(f"{base}/delivery_log").where(
            F.col("timestamp") < F.lit(win.run_text).cast("timestamp"))
    log = run_log_so_far(tables, base, win, earlier)
    s = build_scoring(tables, win, vocab, model, n=n, score_log=log, scores=scores, rollout_bits=rollout_bits)
    s.outbox = materialize(s.outbox)
    sent = s.outbox.withColumn("timestamp", F.lit(win.run_text).cast("timestamp"))
    _write_run(s.prediction_log, f"{base}/prediction_log", win)
    _write_run(sent, f"{base}/outbox", win, "json")
    if delivered is None:
        _write_run(outbox.delivery_rows(s.outbox, win), f"{base}/delivery_log", win)
    _write_run(outbox.run_log_row(spark, win), f"{base}/run_log", win)
    s.written = {"score_rows": spark.read.schema(score_rows.schema).parquet(run_folder(f"{base}/score_log", win)),
                 "prediction_log": spark.read.schema(s.prediction_log.schema).parquet(run_folder(f"{base}/prediction_log", win)),
                 "outbox": spark.read.schema(sent.schema).json(run_folder(f"{base}/outbox", win)).drop("timestamp")}
    return s
