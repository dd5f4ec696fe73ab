"""The jobs: turnover, form 101, min/max, mirror, loader, run log, exchange, counts, run_all."""
