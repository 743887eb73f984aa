"""DataFrame-to-DataFrame operators; none of them starts a job unless its text says so."""
