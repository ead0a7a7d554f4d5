"""Upload jobs: their states, what a restart makes of them, their logs and their results.

A user's events stand for a job's log: an event is a line, the last one tells the state.
"""

from __future__ import annotations

from tabulith.plans.graph import relation

LOG_TAIL = 40


@relation("events", query=False)
def job_states(d, events):
    """A row a job: when it came (the number of its first event), and its state, by its last event."""
    return f"""
  SELECT user_id AS job, min(event_id) AS created, count(*) AS n_lines, max_by(event_type, event_id) AS last_event,
    CASE max_by(event_type, event_id) WHEN 'signup' THEN 'queued' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'done' WHEN 'click' THEN 'no_sets' ELSE 'error' END AS status
  FROM {events} WHERE user_id IS NOT NULL GROUP BY user_id"""


@relation("job_states")
def job_restart(d, jobs):
    """Jobs as a restart finds them: what was queued or running is an error."""
    return f"""
  SELECT job, created, n_lines, CASE WHEN status IN ('queued', 'running') THEN 'error' ELSE status END AS status, CASE WHEN status IN ('queued', 'running') THEN 'interrupted by a restart' END AS error FROM {jobs}"""


@relation("job_restart")
def job_listing(d, jobs):
    """Jobs, the newest first."""
    return f"SELECT job, status, created FROM {jobs} ORDER BY created DESC, job"


@relation("events")
def job_log_tail(d, events):
    """The last forty lines of each job's log, numbered in its order."""
    return f"""
  SELECT job, n - back + 1 AS line, event_id, event_type FROM (
    SELECT e.user_id AS job, e.event_id, e.event_type, j.n, row_number() OVER (PARTITION BY e.user_id ORDER BY e.event_id DESC) AS back
    FROM {events} e JOIN (SELECT user_id, count(*) AS n FROM {events} GROUP BY user_id) j ON j.user_id = e.user_id) q
  WHERE back <= {LOG_TAIL}"""


@relation("catalog_streams")
def job_summary(d, streams):
    """What the upload jobs made (a project's uploads are one job): sums over their streams."""
    total = lambda c: f"CAST(sum({c}) AS BIGINT) AS {c}"
    return f"SELECT {d.div('stream', '10')} AS job, count(*) AS n_streams, {', '.join(map(total, ('n_sets', 'n_components', 'n_empty', 'high', 'medium', 'low')))} FROM {streams} WHERE origin = 'upload' GROUP BY {d.div('stream', '10')}"
