"""Run history, trial and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import folds, runs
from vitrine.operators.registry import production_card, production_info, promote
from vitrine.queries.adapters import Tables, with_tables
from vitrine.queries.registry import query


@query("best_epochs", with_tables("curves") + """
    SELECT run_id, epoch, val_f1 FROM curves WHERE val_f1 > 0
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY val_f1 DESC, epoch) = 1""")
def best_epochs(t: Tables):
    return runs.best_epochs(t.curves).select("run_id", "epoch", "val_f1")


@query("final_metrics", with_tables("curves") + """
    SELECT run_id, arg_max(val_acc, (val_f1, -epoch)) AS final_val_acc, max(val_f1) AS final_val_f1_macro,
           min(val_loss) AS best_val_loss
    FROM curves GROUP BY run_id""")
def final_metrics(t: Tables):
    return runs.final_metrics(t.curves)


PATIENCE = 2


@query("early_stopping", with_tables("curves", recursive=True).rstrip() + f""",
    steps AS (SELECT run_id, epoch, val_loss AS loss, row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS pos
              FROM curves),
    walk AS (
        SELECT run_id, pos, loss AS best, epoch AS best_epoch, 0 AS counter, NULL::INT AS stop
        FROM steps WHERE pos = 1
        UNION ALL
        SELECT w.run_id, s.pos,
               CASE WHEN s.loss < w.best - 1e-4::DOUBLE THEN s.loss ELSE w.best END,
               CASE WHEN s.loss < w.best - 1e-4::DOUBLE THEN s.epoch ELSE w.best_epoch END,
               CASE WHEN s.loss < w.best - 1e-4::DOUBLE THEN 0 ELSE w.counter + 1 END,
               CASE WHEN NOT s.loss < w.best - 1e-4::DOUBLE AND w.counter + 1 >= {PATIENCE} THEN s.epoch END
        FROM walk w JOIN steps s ON s.run_id = w.run_id AND s.pos = w.pos + 1
        WHERE w.stop IS NULL)
    SELECT run_id, best AS best_loss, best_epoch, stop AS stop_epoch FROM walk
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY pos DESC) = 1""")
def early_stopping(t: Tables):
    return folds.early_stopping(t.curves, patience=PATIENCE)


@query("learning_rates", with_tables("curves", recursive=True).rstrip() + """,
    steps AS (SELECT run_id, epoch, val_loss AS loss, row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS pos
              FROM curves),
    walk AS (
        SELECT run_id, pos, epoch, loss AS best, 0 AS bad, 0.001::DOUBLE AS lr FROM steps WHERE pos = 1
        UNION ALL
        SELECT w.run_id, s.pos, s.epoch,
               CASE WHEN s.loss < w.best * 0.9999::DOUBLE THEN s.loss ELSE w.best END,
               CASE WHEN s.loss < w.best * 0.9999::DOUBLE THEN 0 WHEN w.bad + 1 > 1 THEN 0 ELSE w.bad + 1 END,
               CASE WHEN NOT s.loss < w.best * 0.9999::DOUBLE AND w.bad + 1 > 1 THEN w.lr / 2 ELSE w.lr END
        FROM walk w JOIN steps s ON s.run_id = w.run_id AND s.pos = w.pos + 1)
    SELECT run_id, epoch, lr AS learning_rate FROM walk""")
def learning_rates(t: Tables):
    return folds.learning_rates(t.curves, patience=1)


@query("run_ordinals", with_tables("runs") + """
    SELECT run_id, final_val_f1_macro, 'run ' || row_number() OVER (ORDER BY start_time, run_id) AS run
    FROM runs WHERE final_val_f1_macro IS NOT NULL""")
def run_ordinals(t: Tables):
    return runs.run_ordinals(t.runs).select("run_id", "final_val_f1_macro", "run")


@query("newest_run", with_tables("runs") + """
    SELECT run_id, start_time, data_run_id FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 1""")
def newest_run(t: Tables):
    return runs.newest_run(t.runs).select("run_id", "start_time", "data_run_id")


@query("runs_table", with_tables("runs", "versions") + """
    SELECT run_id, final_val_f1_macro AS f1_macro,
           strftime(start_time AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris', '%Y-%m-%d %H:%M') AS started,
           data_run_id,
           CASE WHEN end_time > start_time
                THEN round((epoch_us(end_time) - epoch_us(start_time)) / 60e6::DOUBLE, 1) END AS duration_min,
           CASE stage WHEN 'Production' THEN '🟢 Production' WHEN 'Archived' THEN '⚫ Archived' ELSE '⚪ —' END AS status
    FROM runs LEFT JOIN versions USING (run_id)""")
def runs_table(t: Tables):
    return runs.runs_table(t.runs, t.versions)


@query("trial_summary", with_tables("trials") + """
    SELECT count(*) FILTER (state = 'COMPLETE') AS n_trials_completed,
           max(value) FILTER (state = 'COMPLETE') AS best_value,
           arg_max(trial, (value, -trial)) FILTER (state = 'COMPLETE') AS best_trial,
           arg_max(params, (value, -trial)) FILTER (state = 'COMPLETE') AS best_params
    FROM trials""")
def trial_summary(t: Tables):
    return runs.trial_summary(t.trials)


@query("promote_models", with_tables("runs", "versions", "challengers").rstrip() + """,
    champion AS (SELECT name, max(version) AS last,
                        coalesce(max(CASE WHEN stage = 'Production' THEN coalesce(final_val_f1_macro, 0) END), 0) AS f1
                 FROM versions JOIN runs USING (run_id) GROUP BY name),
    duel AS (SELECT c.name, c.run_id, coalesce(last, 0) + 1 AS version,
                    coalesce(r.final_val_f1_macro, 0) > coalesce(champion.f1, 0) AS wins
             FROM challengers c JOIN runs r USING (run_id) LEFT JOIN champion ON c.name = champion.name)
    SELECT v.name, v.version, v.run_id, v.stage FROM versions v LEFT JOIN duel d ON v.name = d.name
    WHERE NOT (coalesce(wins, false) AND stage IN ('Production', 'Archived'))
    UNION ALL
    SELECT name, version, run_id, CASE WHEN wins THEN 'Production' ELSE 'None' END FROM duel""")
def promote_models(t: Tables):
    return promote(t.versions, t.challengers, t.runs)


@query("production_runs", with_tables("runs", "versions") + """
    SELECT name, version, run_id, final_val_f1_macro, data_run_id
    FROM versions JOIN runs USING (run_id) WHERE stage = 'Production'""")
def production_runs(t: Tables):
    return production_info(t.versions, t.runs).select(
        "name", "version", "run_id", "final_val_f1_macro", "data_run_id")


@query("production_card", with_tables("runs", "versions") + """
    SELECT name, version, coalesce(final_val_f1_macro, 0) AS f1, data_run_id, '—' AS git_sha,
           CASE WHEN end_time > start_time
                THEN round((epoch_us(end_time) - epoch_us(start_time)) / 60e6::DOUBLE, 1) END AS duration_min,
           strftime(end_time AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris', '%Y-%m-%d %H:%M') AS trained_at,
           round(o_custkey / 7, 4)::VARCHAR AS dropout, o_custkey::VARCHAR AS epochs, o_orderstatus AS activation,
           '—' AS hidden_l1
    FROM versions JOIN runs USING (run_id) WHERE stage = 'Production'""")
def production_card_query(t: Tables):
    history = t.runs.withColumns({"final_val_acc": F.lit(None).cast("double"), "git_sha": F.lit(None).cast("string")})
    return production_card(t.versions, history).select(
        "name", "version", "f1", "data_run_id", "git_sha", "duration_min", "trained_at", "dropout", "epochs",
        "activation", "hidden_l1")


@query("version_stages", with_tables("versions") + """
    SELECT stage, count(*) AS versions FROM versions GROUP BY stage""")
def version_stages(t: Tables):
    return t.versions.groupBy("stage").agg(F.count("*").alias("versions"))
