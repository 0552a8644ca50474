"""Pure Column functions: no function here starts a job or moves rows."""
