"""Where the input tables come from and where reports are written."""
