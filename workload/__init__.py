"""The library run on the driver's tables, with the SQL that checks it."""
