"""Where records come from: snapshot documents, flight documents, text messages."""
