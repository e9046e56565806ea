"""DataFrame operators; each is a plain function without actions unless it says so."""
