"""DataFrame -> DataFrame operators, and ``fit_*`` functions returning small specs."""
