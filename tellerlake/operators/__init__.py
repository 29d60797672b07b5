"""DataFrame operators. None of them collects, caches or starts a job."""
