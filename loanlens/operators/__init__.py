"""Frame-to-frame operators; each builds a lazy plan unless its text says otherwise."""
