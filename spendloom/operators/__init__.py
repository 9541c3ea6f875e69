"""DataFrame operators. Every one keys on ``client`` and never collects."""
