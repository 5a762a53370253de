"""Training-data operators: archives, classifiers, privacy, packing, decontamination,
token files, near-duplicates, quality rules and sharding. Nothing else imports this."""
