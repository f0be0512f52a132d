"""Sources and sinks: flat catalogue tables in, document collections out."""
