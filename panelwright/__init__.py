"""Panel analytics on Spark: survey microdata, tidy grids, fiscal panels.

Every operator is a plain function ``DataFrame -> DataFrame`` (or
``Column -> Column``); nothing here creates a session or changes its settings.
"""
