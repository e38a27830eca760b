"""Named plans: the telemetry program, its dashboard queries, and the shop jobs."""
