"""DataFrame-to-DataFrame operators, parametrised by column name."""
