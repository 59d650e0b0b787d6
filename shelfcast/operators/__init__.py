"""DataFrame-to-DataFrame operators; lazy unless a docstring says otherwise."""
