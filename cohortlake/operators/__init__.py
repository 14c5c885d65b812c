"""Row-level operators: staging rules, quality checks, history, refunds."""
