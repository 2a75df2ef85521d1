"""The five steps: discover, validate, stats, align and materialize."""
